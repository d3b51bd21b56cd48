"""Concatenate and cut: token streams of all documents packed into sequences of one length."""

from __future__ import annotations

import array
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, query, table

_LOADED: dict = {}
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
#: Byte-level tokenizers write each byte as a letter: printable ones as themselves, the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


def id_kind(tokenizer) -> str:
    """Ids are kept in 16 bits where the vocabulary allows it, else in 32 (as codes of ``array`` and numpy)."""
    return "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I"


# How a tokenizer file says that white space only separates, and what its words are.
SEPARATED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]


def separates_chunks(tokenizer) -> bool:
    """Whether a text's ids are its white-space separated chunks' ids one after another, as far as the
    tokenizer's own settings say so; for any others whole texts have to be encoded."""
    settings = json.loads(tokenizer.to_str())
    normalizer, words = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    steps = words.get("pretokenizers", [])
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and len(steps) == 2
        and steps[0].get("pattern") == {"Regex": SEPARATED}
        and (steps[0].get("behavior"), steps[0].get("invert")) == ("Removed", True)
        and steps[1].get("type") == "ByteLevel"
        and not steps[1].get("add_prefix_space")
        and not any(mark.isspace() for added in settings["added_tokens"] for mark in added["content"])
    )


class Encoder(dict):
    """Ids of texts by a tokenizer file, remembering each white-space separated chunk's ids.

    For a tokenizer like ``word_bpe_49k.json`` (NFC, lower case, white space only a separator, words of
    letters, byte-level BPE) a text's ids are its chunks' ids one after another, so each chunk of a
    task is encoded once.  At ``most`` chunks the cache becomes the old one, whose chunks are taken
    over when they occur again, and the old one before is dropped; so frequent chunks stay.

    A chunk that is one word of plain letters, perhaps with marks behind it, goes to the tokenizer's
    model at once: for letters below U+0180 (but the dotted capital I) its normalisation is
    lower-casing and its pre-tokenisation one word.  All others are encoded in full.  A tokenizer of other settings encodes whole texts.
    """

    def __init__(self, path: str, most: int = 150_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.kind, self.model = id_kind(self.tokenizer), self.tokenizer.model
        self.old, self.marks = {}, {"": b""}
        self.by_chunk = separates_chunks(self.tokenizer)

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _in_full(self, text: str) -> bytes:
        return array.array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self._learned(chunk)
        self[chunk] = ids
        return ids

    def _learned(self, chunk: str) -> bytes:
        word = chunk.rstrip(_MARKS)
        if not (word.isalpha() and max(word) < "\u0180" and "\u0130" not in word):
            return self._in_full(chunk)
        marks = chunk[len(word) :]
        if marks not in self.marks:
            self.marks[marks] = self._in_full(marks)
        lower = word.lower()
        if lower != chunk:
            return self[lower] + self.marks[marks]
        letters = lower if lower.isascii() else lower.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array.array(self.kind, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """Little-endian ids of each text, with ``end_id`` after each; null is empty."""
        end, out = array.array(self.kind, [end_id]).tobytes(), []
        for text in texts:
            if not self.by_chunk:
                out.append(self._in_full(text or "") + end)
                continue
            if len(self) > self.most:
                self.old = dict(self)
                self.clear()
                self.marks = {"": b""}
            chunks = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            out.append(b"".join(map(self.__getitem__, chunks)) + end)
        return out


_TOKENS_SQL = "doc_id {id}, ids binary, doc_tokens long, part int, part_start long"


def token_streams(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document its ids and their place in its partition's stream."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, total = Encoder.of(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                ids = encoder.encode(batch.column(1).to_pylist(), end_id)
                sizes = np.array([len(x) for x in ids], np.int64) // np.dtype(encoder.kind).itemsize
                starts = total + np.cumsum(sizes) - sizes
                total += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ids, pa.binary()), pa.array(sizes), pa.array(np.full(len(ids), part, np.int32)),
                     pa.array(starts)],
                    ["doc_id", "ids", "doc_tokens", "part", "part_start"],
                )

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, _TOKENS_SQL.format(id=id_type))


def _pieces(length: int, kind: str):
    """Cut each document's ids at the multiples of ``length`` of the global stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column("ids").to_pylist(), batch.column("at").to_pylist()
            rows, start, sizes, crc, ends, data = [], [], [], [], [], []
            for row, (x, first) in enumerate(zip(ids, at)):
                x = np.frombuffer(x, kind).astype("<u4")
                a, n = 0, len(x)
                while a < n:
                    b = min(n, a + length - (first + a) % length)
                    rows.append(row)
                    start.append(a)
                    sizes.append(b - a)
                    data.append(x[a:b].tobytes())
                    crc.append(zlib.crc32(data[-1]))
                    ends.append(first + a)
                    a = b
            place = np.array(ends, np.int64)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("doc_id"), pa.array(start, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()),
                 taken.column("doc_tokens"), pa.array(place // length), pa.array(place % length), pa.array(data, pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset and the ids themselves (little-endian 32-bit).

    First pass: every partition encodes its documents as one stream and writes it with each
    document's place in it.  The partitions' totals (one row each) get prefix sums, which are the
    partitions' places in the global stream.  Second pass: each document's ids are cut where the
    global stream crosses a multiple of ``length``.  Only the last sequence is short.

    Null or empty text is the end id alone.  Repeated rows are packed each; a null id is carried
    along.  No rows give no pieces.  Other columns are not read.
    """
    kind = id_kind(Encoder.of(tokenizer).tokenizer)
    streams = materialise(token_streams(docs, tokenizer, end_id, id_col, text_col), "tokens")
    totals = streams.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    # One row per partition of the input, so this window and the broadcast are as small as the driver's list of tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_at"))
    placed = streams.join(F.broadcast(offsets), "part")
    placed = placed.select("doc_id", "ids", "doc_tokens", (F.col("part_at") + F.col("part_start")).alias("at"))
    id_type = streams.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(
        _pieces(length, kind),
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): every sequence whole, its pieces in order; boundary records meet by their id."""
    piece = F.struct("offset", "ids")
    whole = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda out, p: F.concat(out, p["ids"]))
    return whole.select("sequence_id", joined.alias("ids"))


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizer("word_bpe_49k.json")).drop("ids")
