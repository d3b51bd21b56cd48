"""The best rows of each group, without gathering a hot group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SALTS = 64


def top_n_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """Rows ranked 1..n within each group.

    For small ``n`` Spark's window group limit keeps at most ``n`` rows per
    group and input partition before shuffling.  For large ``n``, where that
    rule is off, the same cut is made by hand over salted groups.
    """
    # Up to this rank Spark itself cuts each partition before the shuffle.
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(df)]), F.lit(SALTS)))
        window = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_local", F.row_number().over(window)).filter(F.col("_local") <= n)
        df = df.drop("_local", "_salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def _hashable(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
