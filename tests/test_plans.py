"""What the plans must look like for large tables."""

import pytest

from docquarry import catalog

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name, mode="formatted"):
    df = catalog.QUERIES[name](spark, FOLDER)
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.mark.parametrize(
    "name,wanted",
    [
        ("bool_filter_page", ["GreaterThanOrEqual(value,50.0)", "In(event_type", "TakeOrderedAndProject"]),
        ("range_date_tz", ["GreaterThanOrEqual(ts,2024-01-01T22:00)", "LessThan(ts,2024-01-03T22:00)"]),
        ("wildcard_prefix", ["StringStartsWith(source,src1)"]),
        ("keyset_page", ["LessThanOrEqual(o_totalprice,250000.5)"]),
        ("top_hits", ["WindowGroupLimit"]),
        ("children_inner_hits", ["WindowGroupLimit", "EqualTo(l_returnflag,R)"]),
    ],
)
def test_plan_contains(spark, name, wanted):
    text = plan(spark, name)
    for w in wanted:
        assert w in text, w


def test_scans_read_only_what_they_need(spark):
    assert "ReadSchema: struct<>" in plan(spark, "match_all_count")
    assert "ReadSchema: struct<l_extendedprice:double,l_discount:double>" in plan(spark, "max_script")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cartesian_product_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text, bad
