"""Line deduplication: near lines by MinHash of character runs, edit similarity, connected groups.

``repeated_lines`` is what the query and the pipeline use; ``line_groups`` retrieves by SimHash of words,
which finds lines of nearly the same words only.

Built-in functions only.
"""

from __future__ import annotations

import random
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shuffles_removed
from .common import materialise, query, table
from .components import connected_components

BITS = 64
#: Rows of ids that may be broadcast: 16 MB at 16 bytes.
SMALL_ROWS = 1_000_000
#: Characters of a run, in lines below LONG characters and in others.  Lines near LONG have runs of both widths.
SHORT_WIDTH, LONG_WIDTH, LONG = 3, 5, 100
#: Minima of a line.  A band joins three of them, and no two bands share more than one.
MINIMA, BANDS, STEPS = 36, 24, (0, 1, 4)
#: Of the first 32 minima so many agree in near lines, at least.
AGREE = 7
#: Lines up to this length also meet by what is left of them without one character.
TINY = 14
#: Where a line is; of a group the least place is kept.
PLACE = ["doc_id", "version", "line_no"]
_DRAW = random.Random(10)
_MASKS = [_DRAW.getrandbits(64) - (1 << 63) for _ in range(MINIMA)]


def normalised(text: Column) -> Column:
    """Lower case, with one space for each run of characters other than letters, their combining marks, digits and newlines."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}\n]+", " ")


def _lanes() -> list[Column]:
    """32 sums per line; each holds two of the 64 bit counts, 32 bits apart."""
    mask = F.lit(0x0000000100000001)
    return [F.sum(F.shiftrightunsigned("hash", j).bitwiseAND(mask)).alias(f"s{j}") for j in range(32)]


def _fingerprint(words: Column) -> Column:
    """Bit b is set if more than half of the words' hashes have it set; bit b is in lane b // 32 of sum b % 32."""
    bits = [
        F.when(
            F.shiftrightunsigned(f"s{b % 32}", 32 * (b // 32)).bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > words,
            F.lit(1 << b if b < 63 else -(1 << 63)),
        ).otherwise(F.lit(0))
        for b in range(BITS)
    ]
    # A balanced tree keeps the expression shallow.
    while len(bits) > 1:
        bits = [bits[i].bitwiseOR(bits[i + 1]) for i in range(0, len(bits), 2)]
    return bits[0].cast("long")


def _block_keys(distance: int, blocks: int) -> Column:
    """One key for each choice of ``blocks - distance`` of the blocks: two fingerprints at most
    ``distance`` bits apart differ in at most so many blocks, so one choice is equal in both."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        parts.append(F.hash(F.lit(number), F.col("print").bitwiseAND(F.lit(mask))))
    return F.array(*parts)


def version(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.lit(2), text)


def occurrences(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, version, line_no, k, k2, norm) of every line of at least ``min_words`` words; k and k2
    together are a 128-bit name of the normalised line."""
    # The outer form of explode: the inner one would add a filter that computes the array again.
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), version(F.col(text_col)).alias("version"), normalised(F.col(text_col)).alias("text")
    )
    lines = texts.select("doc_id", "version", F.posexplode_outer(F.split("text", "\n", -1)).alias("line_no", "norm"))
    lines = lines.withColumn("norm", F.trim("norm"))
    # With fewer words, the text before the last space asked for is the whole line.
    enough = F.substring_index("norm", " ", min_words - 1) != F.col("norm") if min_words > 1 else F.col("norm") != ""
    return lines.where(enough).select("doc_id", "version", "line_no", F.xxhash64("norm").alias("k"), F.xxhash64(F.lit(1), "norm").alias("k2"), "norm")


def fingerprints(lines: DataFrame) -> DataFrame:
    """(k, k2, doc_id, version, line_no, n, chars, print): one row per distinct normalised line, with its first
    occurrence and its number of occurrences.

    Words are exploded and summed in the map tasks, and only sums are shuffled, not texts.  A line's
    occurrences in one input partition are one group: its sums are multiples of one occurrence's,
    which leaves the fingerprint, and stay below 2**32 however often the line occurs elsewhere.
    """
    words = lines.select(
        "k", "k2", F.spark_partition_id().alias("part"), F.length("norm").alias("chars"),
        F.explode_outer(F.split("norm", " ")).alias("word"),
    )
    hashed = words.select("k", "k2", "part", "chars", F.xxhash64("word").alias("hash"))
    summed = hashed.groupBy("k", "k2", "part").agg(F.count("*").alias("words"), F.max("chars").alias("chars"), *_lanes())
    prints = summed.select("k", "k2", "chars", _fingerprint(F.col("words")).alias("print"))
    prints = prints.groupBy("k", "k2").agg(F.max("chars").alias("chars"), F.max("print").alias("print"))
    least = lines.groupBy("k", "k2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    inside = lines.groupBy("k", "k2", "doc_id", "version").agg(F.min("line_no").alias("line_no"))
    inside = inside.groupBy("k", "k2", "doc_id").agg(F.min(F.struct("version", "line_no")).alias("at"))
    first = least.join(inside, ["k", "k2", "doc_id"]).select("k", "k2", "doc_id", "at.*", "n")
    return first.join(prints, ["k", "k2"]).select("k", "k2", "doc_id", "version", "line_no", "n", "chars", "print")


def _near(a: str, b: str, distance: int, percent: int) -> Column:
    """Whether two lines are at most ``distance`` bits apart and their lengths allow the similarity."""
    bits = F.bit_count(F.col(f"{a}print").bitwiseXOR(F.col(f"{b}print"))) <= distance
    shorter, longer = F.least(f"{a}chars", f"{b}chars"), F.greatest(f"{a}chars", f"{b}chars")
    return bits & (100 * shorter >= percent * longer)


def _in_order(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _links(prints: DataFrame, lines: DataFrame, distance: int, blocks: int, percent: int) -> DataFrame:
    """(a, b): links between distinct lines that connect what all near and similar pairs would.

    In each bucket all members meet its middle, the most frequent line.  Members that are not
    linked to it (the rest, few in a family of variants of one line) then meet all members.  So
    two lines linked to one middle make no pair of their own.
    """
    # The wide shuffle carries names only; fingerprints join the few rows that share a bucket.
    keyed = prints.select("k", F.explode(_block_keys(distance, blocks)).alias("bucket"))
    sized = keyed.withColumn("size", F.count("*").over(Window.partitionBy("bucket"))).where("size > 1")
    shared = sized.join(prints.select("k", "n", "chars", "print"), "k")
    inside = Window.partitionBy("bucket").orderBy(F.desc("n"), "k")
    rows = shared.withColumn("middle", F.first(F.struct("k", "chars", "print")).over(inside)).where("k <> middle.k")
    rows = materialise(rows.withColumn("ok", _near("", "middle.", distance, percent)), "buckets")

    stars = materialise(rows.where("ok").select(*_in_order("k", "middle.k")).distinct(), "pairs")
    linked, failed = _verified(stars, lines, percent)
    several = rows.where("size > 2").select("bucket", "k", "chars", "print", "ok", *_in_order("k", "middle.k"))
    marked = several.join(failed.withColumn("failed", F.lit(True)), ["a", "b"], "left")
    rest = marked.where("not ok or failed").select(
        "bucket", F.col("k").alias("r_k"), F.col("chars").alias("r_chars"), F.col("print").alias("r_print")
    )
    more = rest.join(several, "bucket").where((F.col("r_k") != F.col("k")) & _near("r_", "", distance, percent))
    pairs = materialise(more.select(*_in_order("r_k", "k")).distinct(), "pairs")
    return linked.unionAll(_verified(pairs, lines, percent)[0])


def small_or_plain(df: DataFrame) -> DataFrame:
    """A written table of ids, broadcast if it has at most SMALL_ROWS rows."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def _verified(pairs: DataFrame, lines: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, failed): pairs whose normalised texts have an edit similarity of ``percent`` / 100, and the others."""
    needed = materialise(pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct(), "needed")
    texts = lines.select("k", "norm").join(small_or_plain(needed), "k").groupBy("k").agg(F.min("norm").alias("norm"))
    both = pairs.join(texts.select(F.col("k").alias("a"), F.col("norm").alias("x")), "a")
    both = both.join(texts.select(F.col("k").alias("b"), F.col("norm").alias("y")), "b")
    longest = F.greatest(F.length("x"), F.length("y"))
    both = both.withColumn("most", F.floor(longest * (100 - percent) / 100).cast("int"))
    judged = both.select("a", "b", (F.expr("levenshtein(x, y, most)") >= 0).alias("same"))
    judged = materialise(judged, "judged")
    return judged.where("same").select("a", "b"), judged.where("not same").select("a", "b")


def _grouped(lines: DataFrame, prints: DataFrame, components: DataFrame) -> DataFrame:
    """The rows of every line that has a duplicate, of (node, component) of linked lines' names, with the
    versions of their documents."""
    named = prints.select("k", "k2", "n", F.struct(*PLACE).alias("first"))
    grouped = named.join(components.withColumnRenamed("node", "k"), "k", "left")
    in_group = grouped.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    fuzzy = grouped.join(in_group, "component").select("k", "k2", F.col("least").alias("kept_at"))
    equal = grouped.where("component is null and n > 1").select("k", "k2", F.col("first").alias("kept_at"))
    members = materialise(fuzzy.unionAll(equal), "members")
    found = lines.select(*PLACE, "k", "k2").join(small_or_plain(members), ["k", "k2"])
    at = F.struct(*PLACE)
    return found.select(
        *PLACE,
        F.col("kept_at.doc_id").alias("group_doc_id"),
        F.col("kept_at.line_no").alias("group_line_no"),
        (at == F.col("kept_at")).alias("kept"),
    )


def line_groups(
    docs: DataFrame,
    percent: int = 80,
    distance: int = 3,
    blocks: int = 5,
    min_words: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every line that has a duplicate: doc_id, line_no, group_doc_id, group_line_no, kept.

    Lines are what newlines separate, numbered from 0.  Two lines are linked if their normalised
    forms are equal, or if their SimHash fingerprints (64 bits over words) are at most ``distance``
    bits apart and their edit similarity, 1 - levenshtein / longer length, is ``percent`` / 100 or
    more.  Of each connected group the first occurrence in the document of the smallest id is kept,
    and names the group.

    Blank lines and lines of fewer than ``min_words`` words are no duplicates of anything.  Null
    texts have no lines; rows without an id are left alone; equal rows of an id are one document,
    and rows of an id with different texts several, in the order of a hash.  A repeated line counts
    once in every later step.  No rows give no rows.
    """
    lines = materialise(occurrences(docs, min_words, id_col, text_col), "lines")
    prints = materialise(fingerprints(lines), "prints")
    return _grouped(lines, prints, connected_components(_links(prints, lines, distance, blocks, percent))).drop("version")


def _turned(j: int) -> Column:
    """The hash under permutation ``j``: turned by some bits, so that others decide, and masked."""
    by = 64 * j // MINIMA
    turned = F.shiftleft("hash", by).bitwiseOR(F.shiftrightunsigned("hash", 64 - by)) if by else F.col("hash")
    return turned.bitwiseXOR(F.lit(_MASKS[j]))


def sketches(lines: DataFrame, percent: int) -> DataFrame:
    """(k, k2, doc_id, version, line_no, n, chars, width, bands, s0 to s3): for each distinct line its first
    occurrence, number of occurrences, bands of minima and the low bytes of 32 minima.

    Lines that may be similar to shorter and longer ones have a row of each width.  Texts are
    shuffled once; runs are cut and reduced where the line then is.
    """
    distinct = lines.groupBy("k", "k2").agg(
        F.min(F.struct(*PLACE)).alias("at"), F.count("*").alias("n"), F.first("norm").alias("norm")
    )
    chars = F.length("norm")
    widths = F.array_compact(
        F.array(F.when(chars < LONG, F.lit(SHORT_WIDTH)), F.when(100 * chars >= percent * LONG, F.lit(LONG_WIDTH)))
    )
    # A place in a chunk is near its start, so cutting runs out of a long line takes linear time.
    chunks = distinct.select(
        "k", "k2", "at.*", "n", chars.alias("chars"), F.explode(widths).alias("width"),
        F.regexp_extract_all("norm", F.lit("(?s).{1,64}"), F.lit(0)).alias("chunks"),
    )
    own = ["k", "k2", *PLACE, "n", "chars", "width"]
    places = chunks.select(*own, "chunks", F.explode(F.sequence(F.lit(0), F.size("chunks") - 1)).alias("i"))
    after = F.substring(F.coalesce(F.get("chunks", F.col("i") + 1), F.lit("")), F.lit(1), F.col("width") - 1)
    pieces = places.select(*own, F.concat(F.get("chunks", "i"), after).alias("piece"))
    # Runs are rows before they are hashed: plain columns become compiled code, functions over arrays do not.
    runs = F.length("piece") - F.col("width") + 1
    begun = pieces.select(*own, "piece", F.explode_outer(F.when(runs > 0, F.sequence(F.lit(1), runs))).alias("at"))
    run_hash = F.when(F.col("at").isNotNull(), F.xxhash64(F.substring("piece", F.col("at"), F.col("width"))))
    hashed = begun.select(*own, run_hash.alias("hash"))
    least = hashed.groupBy(*own).agg(*[F.min(_turned(j)).alias(f"m{j}") for j in range(MINIMA)])
    bands = [F.hash("width", F.lit(j), *[F.col(f"m{(j + step) % MINIMA}") for step in STEPS]) for j in range(BANDS)]
    bytes_ = [[F.shiftleft(F.col(f"m{8 * part + b}").bitwiseAND(F.lit(255)), 8 * b) for b in range(8)] for part in range(4)]
    packed = [reduce(Column.bitwiseOR, eight).alias(f"s{part}") for part, eight in enumerate(bytes_)]
    return least.select(*own, F.when(F.col("m0").isNotNull(), F.array(*bands)).alias("bands"), *packed)


def _without_one(lines: DataFrame) -> DataFrame:
    """(k, width, n, bucket): the short lines' names by their texts and their texts without one character."""
    tiny = lines.where(F.length("norm") <= TINY).groupBy("k", "norm").agg(F.count("*").alias("n"))
    left = F.transform(
        F.sequence(F.lit(1), F.length("norm")),
        lambda at: F.concat(F.substring("norm", F.lit(1), at - 1), F.substring("norm", at + 1, F.lit(TINY))),
    )
    keys = F.array_distinct(F.array_append(left, F.col("norm")))
    return tiny.select("k", F.lit(SHORT_WIDTH).alias("width"), "n", F.explode(F.transform(keys, lambda x: F.hash(x))).alias("bucket"))


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether two lines' lengths allow the similarity and enough minima agree; short ones need no minima."""
    unequal = F.lit(0)
    for part in range(4):
        x = F.coalesce(F.col(f"{a}s{part}"), F.lit(0)).bitwiseXOR(F.coalesce(F.col(f"{b}s{part}"), F.lit(0)))
        for by in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, by))
        unequal = unequal + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    shorter, longer = F.least(f"{a}chars", f"{b}chars"), F.greatest(f"{a}chars", f"{b}chars")
    return (100 * shorter >= percent * longer) & ((longer <= TINY) | (unequal <= 32 - AGREE))


def _similar(prints: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what all retrieved pairs of similar lines would.

    As in ``_links``, a bucket's members meet its middle, and only those not linked to it all others.
    """
    fields = ["chars", "s0", "s1", "s2", "s3"]
    sketch = prints.select("k", "width", *fields)
    # One exchange of names finds the buckets and their middles; sketches join what is left of it.
    keyed = prints.select("k", "width", "n", F.explode("bands").alias("bucket")).unionAll(_without_one(lines))
    middle = F.first(F.struct("k", "width")).over(Window.partitionBy("bucket").orderBy(F.desc("n"), F.desc("k")))
    placed = keyed.withColumn("m", middle).select("bucket", "k", "width", F.col("m.k").alias("m_k"), F.col("m.width").alias("m_width"))
    starred = materialise(placed.where("k <> m_k"), "starred")

    pairs = starred.select("k", "width", "m_k", "m_width").distinct().join(sketch, ["k", "width"])
    pairs = pairs.join(sketch.withColumnsRenamed({c: f"m_{c}" for c in sketch.columns}), ["m_k", "m_width"])
    stars = pairs.where(_alike("", "m_", percent)).select(*_in_order("k", "m_k")).distinct()
    linked, _ = _verified(materialise(stars, "pairs"), lines, percent)
    linked = materialise(linked, "linked")

    several = starred.select("bucket", "k", "width", *_in_order("k", "m_k"))
    rest = several.join(small_or_plain(linked), ["a", "b"], "left_anti").select("bucket", "k", "width")
    rest = materialise(rest, "rest")
    open_ = several.join(rest.select("bucket").distinct(), "bucket", "left_semi").select("bucket", "k", "width")
    members = open_.join(sketch, ["k", "width"])
    asking = rest.join(sketch, ["k", "width"]).select("bucket", *[F.col(c).alias(f"r_{c}") for c in ("k", *fields)])
    more = asking.join(members, "bucket").where((F.col("r_k") != F.col("k")) & _alike("r_", "", percent))
    pairs = materialise(more.select(*_in_order("r_k", "k")).distinct(), "pairs")
    return linked.unionAll(_verified(pairs, lines, percent)[0])


def repeated_line_places(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``repeated_lines`` with ``version``, which tells rows of one id with different texts apart."""
    # A step's result is written, so what it shuffled is not needed beyond it.
    with shuffles_removed(docs.sparkSession):
        lines = materialise(occurrences(docs, 1, id_col, text_col), "lines", "zstd")
        prints = materialise(sketches(lines, percent), "prints")
        one_each = prints.where((F.col("width") == SHORT_WIDTH) | (F.col("chars") >= LONG))
        return _grouped(lines, one_each, connected_components(_similar(prints, lines, percent)))


def repeated_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every line that has a duplicate, as ``line_groups`` returns them, but of any length above blank.

    Two lines are linked if their normalised forms are equal, or if they share a band of minima of
    their character runs (or all but one character, if short) and their edit similarity is
    ``percent`` / 100 or more.

    Null and empty texts have no lines; rows without an id are left alone; ids may be of any
    orderable type.  Equal rows of an id are one document and give a row each; rows of an id with
    different texts are several.  Texts and lines may be of any length.  Other columns are not read.
    No rows give no rows.
    """
    return repeated_line_places(docs, percent, id_col, text_col).drop("version")


def without_lines(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that ``groups`` does not keep taken out of their texts.

    Documents that lose their last line with a word go; all others stay, changed or not.  Of groups
    with a ``version``, lines are taken out of the text they were found in only, not out of
    another text of the same id.
    """
    keys = [c for c in ("doc_id", "version") if c in groups.columns]
    gone = groups.where("not kept").groupBy(*keys).agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))
    gone = materialise(gone, "gone").withColumnsRenamed({c: f"_gone_{c}" for c in keys})
    here = docs[id_col] == gone["_gone_doc_id"]
    if "version" in keys:
        here = here & (version(docs[text_col]) == gone["_gone_version"])
    joined = docs.join(gone, here, "left")
    kept = F.filter(F.split(text_col, "\n", -1), lambda line, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    emptied = F.col("_gone").isNotNull() & ~F.coalesce(text.rlike(r"[\p{L}\p{N}]"), F.lit(False))
    return joined.where(~emptied).select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


@query("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
