"""Repair of conversations: faults of turns, and the cheapest edits that give a regular order of roles."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import role_grammar as grammar
from .common import query, table

# White space, and what a finished text ends with.
_SPACE = " \t\n\x0b\x0c\r"
_STOPS = (".", "!", "?")
_LEGAL = {"su", "ua", "au"}


def _fault(role: str, text: str, repeated: str) -> Column:
    """The first fault of a row: blank, duplicate, truncated, or none (empty)."""
    told = F.rtrim(F.col(text), F.lit(_SPACE))
    return (
        F.when(told == "", "blank")
        .when(F.col(repeated) > 1, "duplicate")
        .when(~F.right(told, F.lit(1)).isin(*_STOPS), "truncated")
        .otherwise("")
    )


class _Output:
    """Rows of the result, column by column."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.columns: list[list] = [[] for _ in schema]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema
        )
        self.columns = [[] for _ in self.schema]
        return made


class _Chat:
    """One conversation as its rows come by; rows are held until their edit is certain."""

    def __init__(self, out: _Output):
        self.out, self.held = out, deque()
        self.frontier, self.codes, self.before = grammar.START, [], None
        self.written, self.next = 0, "user"

    def take(self, key, turn, role, text, fault) -> None:
        initial = role[:1]
        clash = self.before is not None and self.before + initial not in _LEGAL
        self.before = initial
        code = initial if initial in ("s", "u", "a") else "x"
        if fault in ("blank", "duplicate"):
            code = grammar.MUST_GO
        elif fault == "truncated":
            code = code.upper()
        self.key = key
        self.held.append((turn, role, text, fault, clash))
        self.codes.append(code)
        if len(self.codes) > grammar.CHUNK:
            self._edit("".join(self.codes[: grammar.CHUNK]), False)
            self.codes = self.codes[grammar.CHUNK :]

    def end(self) -> None:
        self._edit("".join(self.codes), True)

    def _edit(self, codes: str, at_end: bool) -> None:
        edits, self.frontier = grammar.advance(self.frontier, codes, at_end)
        for edit in edits:
            self.written += 1
            turn, role, text, fault, clash = (None, None, "", None, False) if edit == grammar.INSERT else self.held.popleft()
            if edit != grammar.DELETE:
                if edit != grammar.KEEP:
                    role = self.next
                if not (edit == grammar.KEEP and role[:1] == "s"):
                    self.next = "user" if self.next == "assistant" else "assistant"
            self.out.add(self.key, self.written, edit, turn, role, text, fault, clash)


def repair(
    turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per edit: id, ``n`` (from 1), ``edit``, turn, role, text, ``fault`` and ``clash``.

    Edits are K (kept), R (its role became user or assistant), D (deleted) and I (a turn without text inserted);
    those but D, by ``n``, are the repaired conversation, whose roles begin like (s?(ua)+)?.  They are the
    cheapest, then the least audit (the edits' letters in order).  ``fault`` is a row's first of blank, duplicate (role and text stood
    before) and truncated; blank and duplicate rows are always deleted.  ``clash``: the letters of its role and of the row's
    before it are not su, ua or au.

    Rows go by ``order_col``, nulls first, then role, then text.  Null roles and texts are one space;
    roles beginning with other letters than s, u, a fit nothing.  Rows without an id are one conversation; repeated rows are duplicates.
    No rows give no rows; other columns are not read.

    A conversation passes through one task, row by row and spilled by Spark's sort, because an edit may hang on all rows before.  What
    the task holds are rows whose edit is open yet: few, unless stacks of equal cost never meet (only rows of other roles).
    """
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.col(order_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    ).repartition("id")
    same = Window.partitionBy("id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    chat = Window.partitionBy("id").orderBy(F.asc_nulls_first("turn"), "role", "text", "seen")
    rows = rows.withColumn("seen", F.row_number().over(same)).withColumn("at", F.row_number().over(chat))
    rows = rows.select("id", "turn", "role", "text", _fault("role", "text", "seen").alias("fault"), "at")

    id_type, turn_type = rows.schema["id"].dataType, rows.schema["turn"].dataType
    schema = pa.schema(
        [("id", to_arrow_type(id_type)), ("n", pa.int64()), ("edit", pa.string()), ("turn", to_arrow_type(turn_type)), ("role", pa.string()),
         ("text", pa.string()), ("fault", pa.string()), ("clash", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = _Output(schema), None
        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            for *values, at in zip(*[c.to_pylist() for c in batch.columns]):
                if at == 1:
                    if current is not None:
                        current.end()
                    current = _Chat(out)
                current.take(*values)
            yield out.batch()
        if current is not None:
            current.end()
            yield out.batch()

    edited = rows.mapInArrow(
        run,
        f"id {id_type.simpleString()}, n long, edit string, turn {turn_type.simpleString()}, role string, text string, "
        "fault string, clash boolean",
    )
    return edited.withColumnsRenamed({"id": id_col}) if id_col != "id" else edited


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by crc32 of "conv_id:turn" modulo 20; nulls are one space.

    0 drops a row, 1 empties its text, 2 takes its [.!?], 3 repeats it, 4 sets its role to user.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", space))
    kept = conversations.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return kept.withColumn("_copy", F.explode(times)).select("conv_id", "turn", "role", "text")


@query("op12_chat_repair")
def op12_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    broken = damaged(given)
    told = lambda fault: F.count_if(F.col("fault") == fault)
    paid = (
        F.when(F.col("edit") == "D", grammar.DELETE_COST).when(F.col("edit") == "I", grammar.INSERT_COST)
        .otherwise(F.when(F.col("edit") == "R", grammar.REROLE_COST).otherwise(0) + F.when(F.col("fault") == "truncated", grammar.TRUNCATED_COST).otherwise(0))
    )
    step = F.struct("n", "edit", F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text")).alias("line"))
    counted = repair(broken).groupBy("conv_id").agg(
        told("blank").alias("blank"),
        told("duplicate").alias("duplicate"),
        told("truncated").alias("truncated"),
        F.count_if("clash").alias("illegal"),
        F.sum(paid).cast("long").alias("cost"),
        F.array_sort(F.collect_list(step)).alias("steps"),
    )
    # Digests before the join, so that no text is shuffled again.
    lines = F.array_join(F.array_compact(F.transform("steps", lambda s: s["line"])), "\n")
    digests = counted.select(
        "conv_id", "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join("steps.edit", "").alias("audit"),
        F.sha2(lines, 256).alias("repaired_sha256"),
    )
    places = broken.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("gaps")
    )
    ids = given.select("conv_id").distinct()
    for part in (places, digests):
        named = part.withColumnRenamed("conv_id", "_id")
        ids = ids.join(named, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
