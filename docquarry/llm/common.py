"""Helpers all operators of this subpackage use: tables, intermediate results, registration."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the same in SQL."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    Cuts the lineage: a lost executor costs a second read of a file, not a second computation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores before it as no column of the table has."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def in_fold(column: str, modulus: int, remainder: int):
    """Whether crc32 of a column's text leaves this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus == remainder
