"""A capped export: the same rows in the same order as a sort and a limit, in many tasks."""

import pytest
from pyspark.sql import functions as F

from docquarry import catalog
from docquarry.operators import queries as q
from docquarry.operators.paging import Sort, first_rows
from docquarry.plans.search import Collection, SearchRequest, search


@pytest.mark.parametrize("limit", [0, 1, 499, 500, 777, 5000, 10**9])
def test_same_rows_in_the_same_order(spark, limit):
    df = spark.range(0, 5000, numPartitions=7).select("id", (F.col("id") * 7919 % 331).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 17).alias("m"))
    sort = [Sort("m", True), Sort("k"), Sort("id")]
    expected = df.orderBy(F.col("m").desc_nulls_last(), F.col("k").asc_nulls_last(), F.col("id")).limit(limit).collect()
    assert first_rows(df, sort, limit).collect() == expected


def test_few_keys_and_no_rows(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("k"))
    assert [r["id"] for r in first_rows(df, [Sort("k"), Sort("id", True)], 3).collect()] == [999, 998, 997]
    assert first_rows(df.where("id < 0"), [Sort("id")], 5).count() == 0


def test_export_gathers_nothing_in_one_task(spark):
    plan = catalog.QUERIES["export_limit"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "SinglePartition" not in plan
    rows = Collection(spark.range(3000).withColumn("v", F.col("id") % 10), "id")
    hits = search(rows, SearchRequest(q.Range("v", gte=5), export=True, limit=1200, sort=[Sort("v", True)])).hits
    assert hits.count() == 1200
