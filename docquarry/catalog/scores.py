"""Function scores: modifiers, boost modes and lists of weighted functions."""

from pyspark.sql import functions as F

from ..operators import queries as q
from ..operators.compile import scored
from .base import query, table

_LABELLED = "documents LEFT JOIN labels USING (doc_id)"


def _labelled(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


def _result(docs, wanted):
    return scored(docs, wanted).select("doc_id", F.round("_score", 6).alias("score"))


_MODIFIERS = {
    "none": "x",
    "log": "log10(x)",
    "log1p": "log10(x + 1)",
    "log2p": "log10(x + 2)",
    "ln": "ln(x)",
    "ln1p": "ln(x + 1)",
    "ln2p": "ln(x + 2)",
    "square": "x * x",
    "sqrt": "sqrt(x)",
    "reciprocal": "1 / x",
}


def _register_modifier(name: str, expression: str) -> None:
    @query(
        f"function_score_{name}",
        f"""WITH v AS (SELECT doc_id, 0.5 * n_chars::DOUBLE AS x FROM documents)
            SELECT doc_id, round(2 * ({expression}), 6) AS score FROM v""",
    )
    def modifier(spark, folder):
        factor = q.FieldValueFactor("n_chars", factor=0.5, modifier=name)
        return _result(table(spark, folder, "documents"), q.FunctionScore(q.MatchAll(), factor, boost=2.0))


_BOOST_MODES = {
    "multiply": "1.5 * v",
    "replace": "v",
    "sum": "1.5 + v",
    "avg": "(1.5 + v) / 2",
    "max": "greatest(1.5, v)",
    "min": "least(1.5, v)",
}


def _register_boost_mode(mode: str, expression: str) -> None:
    @query(
        f"function_score_mode_{mode}",
        f"""WITH f AS (SELECT doc_id, (1.2 * coalesce(quality::DOUBLE, 2.5)) + 0.0 AS v FROM {_LABELLED})
            SELECT doc_id, round({expression}, 6) AS score FROM f""",
    )
    def boost_mode(spark, folder):
        factor = q.FieldValueFactor("quality", factor=1.2, missing=2.5)
        base = q.ConstantScore(q.MatchAll(), boost=1.5)
        return _result(_labelled(spark, folder), q.FunctionScore(base, factor, boost_mode=mode))


_SCORE_MODES = {
    "sum": "coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)",
    "multiply": "coalesce(a, 1) * coalesce(b, 1) * coalesce(c, 1)",
    "avg": """(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0))
              / (CASE WHEN a IS NULL THEN 0 ELSE 2 END + CASE WHEN b IS NULL THEN 0 ELSE 3 END
                 + CASE WHEN c IS NULL THEN 0 ELSE 0.5 END)""",
    "max": "greatest(a, b, c)",
    "min": "least(a, b, c)",
}


def _register_score_mode(mode: str, expression: str) -> None:
    @query(
        f"function_list_{mode}",
        f"""WITH f AS (
                SELECT doc_id,
                       CASE WHEN n_chars >= 1000 THEN 2 * log10(n_chars + 1) END AS a,
                       CASE WHEN lang = 'de' THEN 3.0::DOUBLE END AS b,
                       CASE WHEN quality = 1 THEN 0.5 * sqrt(n_chars) END AS c
                FROM {_LABELLED})
            SELECT doc_id,
                   round(CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN 1.0 ELSE 1.0 + {expression} END, 6) AS score
            FROM f""",
    )
    def score_mode(spark, folder):
        items = [
            q.FunctionItem(q.FieldValueFactor("n_chars", modifier="log1p"), q.Range("n_chars", gte=1000), 2.0),
            q.FunctionItem(None, q.Term("lang", "de"), 3.0),
            q.FunctionItem(q.FieldValueFactor("n_chars", modifier="sqrt"), q.Term("quality", 1), 0.5),
        ]
        wanted = q.FunctionScore(q.MatchAll(), functions=items, boost_mode="sum", score_mode=mode)
        return _result(_labelled(spark, folder), wanted)


for _name, _expression in _MODIFIERS.items():
    _register_modifier(_name, _expression)
for _name, _expression in _BOOST_MODES.items():
    _register_boost_mode(_name, _expression)
for _name, _expression in _SCORE_MODES.items():
    _register_score_mode(_name, _expression)
