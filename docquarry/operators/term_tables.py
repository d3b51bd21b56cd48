"""Term lists too long for a query: the terms are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_term_table(
    docs: DataFrame, field: str, terms: DataFrame, term_col: str, id_col: str | None = None
) -> DataFrame:
    """Documents whose field holds one of the terms; multi-valued fields need ``id_col``.

    A semi join; Spark broadcasts the terms if their size allows and otherwise
    shuffles, splitting skewed keys at run time.  Terms are made distinct first,
    so that a repeated term costs nothing.
    """
    wanted = terms.select(F.col(term_col).alias("_term")).distinct()
    if docs.schema[field].dataType.typeName() == "array":
        if id_col is None:
            raise ValueError(f"field {field!r} is multi-valued, so the id column is needed")
        # Only ids and values are exploded; the documents themselves are met by id.
        values = docs.select(id_col, F.explode(field).alias("_value"))
        found = values.join(wanted, F.col("_value") == F.col("_term"), "left_semi").select(id_col).distinct()
        return docs.join(found, id_col, "left_semi")
    return docs.join(wanted, F.col(field) == F.col("_term"), "left_semi")
