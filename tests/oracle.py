"""Side-by-side comparison of registered queries with their SQL."""

from __future__ import annotations

import math
from pathlib import Path


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, name, function, sql, folder) -> list[str]:
    df = function(spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"{name}: columns {sorted(df.columns)} against {sorted(names)}")
    if len(ours) != len(theirs):
        problems.append(f"{name}: {len(ours)} rows against {len(theirs)}")
    if not problems and ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
        if bad:
            problems.append(f"{name}: {len(bad)} rows differ, first {bad[0]}")
    if not ours and not theirs and name not in ("unknown_field",):
        problems.append(f"{name}: empty on both sides")
    return problems
