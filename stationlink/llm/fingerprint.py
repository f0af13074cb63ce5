"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

The distinct shingles (five words in a row; the words of a shorter text as one) of a text
are hashed once. The top bits of a hash are its bin, the smallest hash of a bin its
value. An empty bin takes the value of the first filled bin on its own fixed walk through
all bins (optimal densification: each empty bin draws by itself, and two texts that have
the same donor agree on it). Of each bin the low ``DIGIT`` bits are kept, packed into
64-bit integers. Two fingerprints agree in a bin with probability J + (1 - J) / 2^DIGIT;
``likeness`` takes the share by chance off.

Words are runs of characters other than space, \\t, \\n, \\v, \\f, \\r, in lower case.
A text without a word has the empty fingerprint; two of those are alike (1), one and any
other text are not (0). Null text counts as empty.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .linededup import let

WORDS = 5
BINS = 256           # bins; the bin is the top byte of a hash
DIGIT = 4            # bits kept of each bin: a digit of the fingerprint
A_LONG = 64 // DIGIT
BLOCKS_A_PARTITION = 4

_r = random.Random(12)
_STEP = [_r.randrange(1, BINS, 2) for _ in range(BINS)]     # odd: the walk meets every bin
_START = [_r.randrange(BINS) for _ in range(BINS)]
_BACK = [pow(s, -1, BINS) for s in _STEP]
SHORT_WALK = 24      # steps that are tried before all filled bins are ranked


def _ints(xs: list[int]) -> str:
    return f"array({', '.join(map(str, xs))})"


def bin_of(h: str) -> str:
    return f"(CAST(shiftright({h}, 56) AS INT) + {BINS // 2})"


def shingles(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the array of shingle hashes of a text column, in the order of the text."""
    blank = r"concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    df = let(df, _w=F.expr(f"transform(split(btrim(lower({text}), {blank}), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> IF(w = '', NULL, xxhash64(w)))"))
    window = ", ".join(f"_w[i + {k}]" for k in range(WORDS))
    return let(df, **{out: F.expr(f"""CASE WHEN _w[0] IS NULL THEN CAST(array() AS ARRAY<BIGINT>)
        WHEN size(_w) < {WORDS} THEN array(aggregate(_w, 0L, (s, x) -> xxhash64(s, x)))
        ELSE transform(sequence(0, size(_w) - {WORDS}), i -> xxhash64({window})) END""")}).drop("_w")


def densified(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """Adds the values of all bins (none for no hash): an empty bin has its donor's."""
    df = let(df, _s=F.sort_array(hashes))
    df = let(df, _m=F.expr(f"filter(_s, (x, i) -> i = 0 OR {bin_of('x')} <> {bin_of('_s[i - 1]')})"))
    gap = f"{bin_of('x')} - IF(i = 0, 0, {bin_of('_m[i - 1]')} + 1)"
    df = let(df, _d=F.expr(f"""concat(
        flatten(transform(_m, (x, i) -> concat(array_repeat(CAST(NULL AS BIGINT), {gap}), array(x)))),
        array_repeat(CAST(NULL AS BIGINT), {BINS - 1} - coalesce({bin_of('try_element_at(_m, -1)')}, {BINS - 1})))"""))
    steps = ([(a * k + c) % BINS for a, c in zip(_STEP, _START, strict=True)] for k in range(SHORT_WALK))
    walk = ", ".join(f"_d[{_ints(s)}[i]]" for s in steps)
    rank = f"(({bin_of('y')} - {_ints(_START)}[i]) * {_ints(_BACK)}[i]) & {BINS - 1}"
    # the steps after the short walk are those of the filled bin with the smallest number of steps
    rest = f"array_min(transform(_m, y -> named_struct('k', {rank}, 'y', y))).y"
    return let(df, **{out: F.expr(f"transform(_d, (x, i) -> coalesce(x, {walk}, {rest}))")}).drop("_s", "_m", "_d")


def packed(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the packed fingerprint of a text column: ``BINS`` / ``A_LONG`` longs, or none."""
    df = densified(shingles(df, text, "_h"), "_h", "_v")
    return df.withColumn(out, F.expr(f"""IF(size(_v) = 0, CAST(array() AS ARRAY<BIGINT>),
        transform(sequence(0, {BINS // A_LONG - 1}), g -> aggregate(slice(_v, g * {A_LONG} + 1, {A_LONG}), 0L,
            (s, x) -> shiftleft(s, {DIGIT}) | (x & {(1 << DIGIT) - 1}))))""")).drop("_h", "_v")


def as_text(fingerprint: str) -> Column:
    """Hexadecimal digits of a packed fingerprint: one for each bin."""
    return F.expr(f"lower(array_join(transform({fingerprint}, x -> lpad(hex(x), {A_LONG}, '0')), ''))")


def likeness(a: str, b: str) -> Column:
    """Estimate, 0 to 1, of the Jaccard likeness of the shingles behind two packed fingerprints."""
    ones = sum(1 << (DIGIT * k) for k in range(A_LONG))
    any_bit = " | ".join(f"shiftrightunsigned(x, {k})" for k in range(DIGIT))
    other = f"aggregate(zip_with({a}, {b}, (x, y) -> x ^ y), 0, (s, x) -> s + bit_count(({any_bit}) & {ones}L))"
    chance = 2.0 ** -DIGIT
    return F.expr(f"""CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1D WHEN size({a}) = 0 OR size({b}) = 0 THEN 0D
        ELSE greatest(0D, (1D - {other} / {float(BINS)}D - {chance}D) / {1 - chance}D) END""")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row: the fingerprint in hexadecimal digits."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return packed(src, "text", "p").select("doc_id", as_text("p").alias("fingerprint"))


def _below(cuts: list[int], key: str, equal: bool) -> str:
    """SQL: how many of the ascending cuts are smaller than (``equal``: or equal to) the key."""
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    array = f"array({', '.join(f'{c}L' for c in cuts)})"
    test = f"{array}[least(at + s, {len(cuts)}) - 1] {'<=' if equal else '<'} {key}"
    return f"aggregate({_ints(steps)}, 0, (at, s) -> IF(at + s <= {len(cuts)} AND {test}, at + s, at))" if cuts else "0"


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, p, next_text, next_p): each row with its packed fingerprint and those
    of the next row by id (null ids first, equal ids by a hash of the text; after the
    last row the first). Null text is empty.

    Rows are dealt to blocks at quantiles of the id, so no task orders the whole table; an
    id that fills several blocks is dealt by the hash of the text. The first row of each
    block is a guest at the end of the block before it. Only rows equal in id and text
    cannot be told apart and stay together.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63) + 1
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("key"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blocks = BLOCKS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / blocks for k in range(1, blocks)]
    cuts = src.select("key").agg(F.percentile_approx("key", shares, max(10000, 10 * blocks)).alias("q")).first().q or []
    rows = src.withColumn("h", F.xxhash64("text"))
    low, high = _below(cuts, "key", False), _below(cuts, "key", True)
    rows = let(rows, lo=F.expr(low), hi=F.expr(high))
    rows = rows.withColumn("block", F.expr("lo + CAST(floor((h / 18446744073709551616D + 0.5D) * (hi - lo + 1)) AS INT)"))
    rows = rows.withColumn("block", F.least("block", "hi")).drop("lo", "hi")
    # one row for each block: its first
    firsts = sorted((r.block, r.at.key, r.at.h) for r in rows.groupBy("block").agg(F.min(F.struct("key", "h")).alias("at")).collect())
    host = [(key, h, firsts[i - 1][0]) for i, (_, key, h) in enumerate(firsts)]
    host = spark.createDataFrame(host, "key long, h long, host int")
    guests = rows.drop("block").join(F.broadcast(host), ["key", "h"]).dropDuplicates(["host"]).select(
        "doc_id", "key", "text", "h", F.col("host").alias("block"), F.lit(True).alias("guest"))
    both = packed(rows.withColumn("guest", F.lit(False)).unionByName(guests), "text", "p")
    order = "OVER (PARTITION BY block ORDER BY guest, key, h)"
    both = both.withColumns({"next_text": F.expr(f"lead(text) {order}"), "next_p": F.expr(f"lead(p) {order}")})
    return both.where("NOT guest").select("doc_id", "text", "p", "next_text", "next_p")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The edited text has its last half (rounded
    down) replaced by as many code points from the start of the next row's text."""
    rows = let(with_next(docs, id_col, text_col), n=F.length("text"))
    rows = let(rows, edited=F.expr("concat(substring(text, 1, n - n DIV 2), substring(next_text, 1, n DIV 2))"))
    rows = packed(rows.drop("text", "next_text"), "edited", "q")
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), as_text("p").alias("fingerprint"),
        as_text("q").alias("edited_fingerprint"), likeness("p", "q").alias("near_edited"), likeness("p", "next_p").alias("near_next"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(read(spark, sf_dir, "documents"))
