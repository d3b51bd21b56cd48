"""Access to fields that may be missing, single- or multi-valued, or inside a struct."""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field_type(schema: T.StructType, name: str) -> T.DataType | None:
    """Type of a (dotted) field, or None if the schema has no such field."""
    current: T.DataType = schema
    for part in name.split("."):
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def as_array(col: Column, dtype: T.DataType) -> Column:
    """All values of a field as an array; NULL values are left out."""
    if isinstance(dtype, T.ArrayType):
        return F.array_compact(col)
    return F.when(col.isNotNull(), F.array(col))


def first_value(col: Column, dtype: T.DataType) -> Column:
    """First value of a field, NULL if there is none."""
    return F.try_element_at(as_array(col, dtype), F.lit(1)) if isinstance(dtype, T.ArrayType) else col


def expand_names(names: list[str], patterns: list[str]) -> list[str]:
    """Names matching any of the patterns (``*`` and ``?``), in schema order."""
    return [n for n in names if any(fnmatchcase(n, p) for p in patterns)]


def project_fields(
    df: DataFrame,
    fields: list[str] | None,
    keep: list[str],
    exclude: list[str] | None = None,
    whole_source: bool = False,
    source_columns: list[str] | None = None,
) -> DataFrame:
    """Select the requested fields plus the columns in ``keep``.

    ``fields=None`` returns every source field, an empty list none of them.
    A name that does not exist is skipped, as a document without it would be.
    ``whole_source`` adds all source fields as one struct ``_source``.
    """
    available = source_columns if source_columns is not None else df.columns
    chosen = list(available) if fields is None else expand_names(available, fields)
    if exclude:
        dropped = set(expand_names(available, exclude))
        chosen = [c for c in chosen if c not in dropped]
    dotted = [
        f for f in (fields or [])
        if "." in f and "*" not in f and f not in available and field_type(df.schema, f) is not None
    ]
    columns: list[Column] = [F.col(f"`{c}`") for c in keep]
    columns += [F.col(f"`{c}`") for c in chosen if c not in keep]
    columns += [F.col(f).alias(f) for f in dotted]
    if whole_source:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in available]).alias("_source"))
    return df.select(*columns)
