"""Benchmark decontamination by canonical templates.

Texts become tokens (runs of letters, runs of digits, single characters of scripts
without spaces; case and punctuation ignored).
Numbers, units after numbers and names (capitalised inside a sentence) turn into typed
placeholders. Windows of ``WINDOW`` template tokens of the documents are hash-joined with
those of the benchmark; a window must fill the item's slots consistently: a value that
stands twice in it is the same value twice. Different values may become equal, and other
windows may fill their slots otherwise. So a copied question is found, and also one with
other numbers or names. There are two more readings. One has no names, so that it does not
depend on capitals. The plain tokens are the other: their windows must be equal, and any of
them counts, so that items of numbers only or of a few tokens are found where they are
copied. An item's first token is a word; in a document each window with a name in front
is read with a word there, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _MUL, _VAL, Scratch, _powers, mix, python_workers, read, text_slices, windows

WINDOW = 8        # template tokens of a window
MIN_WORDS = 4     # tokens of a template window that are no placeholders
MIN_TOKENS = 5    # shorter items have no template window
MIN_COVER = 0.3   # share of an item's windows from which a document is contaminated
BROADCAST_WINDOWS = 2_000_000  # benchmark windows (8 bytes each) up to which documents are sieved by a broadcast set
UNITS = "mm cm m km in ft mi mg g kg lb oz ml l s min h ms hour hours minute minutes second seconds day days week weeks month months year years percent dollars dollar euros euro cents meters metres kilometers kilometres miles feet inches grams kilograms pounds liters litres degrees".split()

_CLS = np.zeros(256, np.uint8)
_CLS[128:] = 1
_CLS[65:91] = _CLS[97:123] = 1
_CLS[48:58] = 2
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_TOK = np.where(_CLS > 0, _VAL[_FOLD], 0).astype(np.uint64)
_END = np.zeros(256, np.int32)
_END[[10, 33, 46, 58, 63]] = 1  # \n ! . : ?
_NUM, _UNIT, _NAME = (np.uint64(x) for x in (11, 13, 17))
TEMPLATE, PLAIN, FOLDED, LED = range(4)  # LED: template windows with a name in front, read as a word


def _single(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start bytes of the characters of scripts without spaces: Thai, Lao, Tibetan, Burmese,
    Khmer, Chinese, Japanese; their end bytes; start bytes of the punctuation of these scripts)."""
    at = np.flatnonzero(buf >= 0xE0)
    a, b, c = buf[at], *(buf[np.minimum(at + k, len(buf) - 1)] for k in (1, 2))
    one = ((a == 0xE0) & (b >= 0xB8)) | ((a == 0xE1) & ((b == 0x80) | (b == 0x81) | ((b == 0x82) & (c < 0xA0)) | (b == 0x9E) | (b == 0x9F))) \
        | ((a == 0xE3) & (b >= 0x81)) | ((a >= 0xE4) & (a <= 0xE9)) | ((a == 0xF0) & (b >= 0xA0)) \
        | ((a == 0xEF) & (((b >= 0xA4) & (b <= 0xAB)) | ((b == 0xBD) & (c >= 0xA6)) | (b == 0xBE) | ((b == 0xBC) & (c >= 0x90) & (c <= 0x99))))
    mark = ((a == 0xE3) & (b == 0x80)) | ((a == 0xEF) & (((b == 0xBC) & ((c < 0x90) | (c > 0x99))) | ((b == 0xBD) & (c < 0xA6))))
    return at[one], at[one] + np.where(a[one] == 0xF0, 4, 3), at[mark]


def _tokens(buf: np.ndarray, off: np.ndarray):
    """(hash, start byte, class of each token, first token of each row + end)."""
    n = len(buf)
    cls = _CLS[buf]
    char, end, mark = _single(buf)
    for k in range(3):
        cls[mark + k] = 0
    start = cls > 0
    start[1:] &= cls[1:] != cls[:-1]
    rows = off[:-1][off[:-1] < n]
    start[rows] = cls[rows] > 0
    start[char] = True
    end = end[end < n]
    start[end] = cls[end] > 0
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(0, np.uint8), np.zeros(len(off), np.int64)
    up, down = _powers(n)
    return mix(np.add.reduceat(np.where(cls > 0, _TOK[buf], np.uint64(0)) * up[:n], starts) * down[starts]), starts, cls[starts], np.searchsorted(starts, off)


def _hash_of(words: list[str]) -> np.ndarray:
    b = " ".join(words).encode()
    return _tokens(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0]


_UNIT_HASHES = np.sort(_hash_of(UNITS))


def readings(buf: np.ndarray, off: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """((token hashes, slot values (0: no slot)) of each reading, first token of each row + end)."""
    h, starts, cls, first = _tokens(buf, off)
    plain = h, np.zeros(len(h), np.uint64)
    if not len(h):
        return [plain] * 4, first
    ends = np.concatenate([[0], np.cumsum(_END[buf])])[starts]
    opens = np.ones(len(h), bool)                     # first of a sentence
    opens[1:] = ends[1:] != ends[:-1]
    opens[first[:-1][first[:-1] < len(h)]] = True
    num = cls == 2
    after = np.zeros(len(h), bool)
    after[1:] = num[:-1]
    unit = after & (_UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, h), len(_UNIT_HASHES) - 1)] == h)
    lead = buf[starts]
    nxt = buf[np.minimum(starts + 1, len(buf) - 1)]
    name = ~opens & (((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (nxt >= 0x80) & (nxt <= 0x9E))) & ~unit
    t = h.copy()
    t[num], t[unit], t[name] = _NUM, _UNIT, _NAME
    slot = np.where(num | unit | name, h, np.uint64(0))
    return [(t, slot), plain, (np.where(name, h, t), np.where(name, np.uint64(0), slot)), (t, slot)], first


def _led(t: np.ndarray, lead: np.ndarray, k: int) -> np.ndarray:
    """``windows`` of tokens of which the first is taken from ``lead``."""
    n = max(len(t) - k + 1, 0)
    out = lead[:n].copy()
    for i in range(1, k):
        out = out * _MUL + t[i:i + n]
    return mix(out)


def _windows(batches: Iterator[pa.RecordBatch], wanted: list[tuple[int, int]], sieve: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows (id, pos, mode, size, hash, slots) of all windows of the wanted readings and
    sizes, or of those in the sieve; ``PLAIN`` ones need not have ``MIN_WORDS`` words."""
    table = None
    if sieve is not None:
        table = np.zeros(1 << 22, bool)
        table[sieve >> np.uint64(42)] = True
    for batch in batches:
        ids = batch.column(0)
        for i, j, buf, off in text_slices(batch.column(1)):
            modes, first = readings(buf, off)
            count = np.diff(first)
            for mode, k in wanted:
                t, slot = modes[mode]
                w = _led(t, modes[PLAIN][0], k) if mode == LED else windows(t, k)
                if not len(w):
                    continue
                ok = table[w >> np.uint64(42)] if table is not None else np.ones(len(w), bool)
                at = np.flatnonzero(ok & (t[:len(w)] == _NAME)) if mode == LED else np.flatnonzero(ok)
                if mode != PLAIN:
                    words = np.concatenate([[0], np.cumsum(slot == 0)])
                    at = at[words[at + k] - words[at] + (mode == LED) >= min(MIN_WORDS, k)]
                if sieve is not None and len(at):
                    at = at[sieve[np.minimum(np.searchsorted(sieve, w[at]), len(sieve) - 1)] == w[at]]
                row = np.searchsorted(first, at, "right") - 1
                inside = at + k <= first[row + 1]
                # a shorter window counts only where it is the whole text of an item; documents offer all
                at, row = at[inside], row[inside]
                if not len(at):
                    continue
                slots = slot[at[:, None] + np.arange(k)].view(np.int64)
                if mode == LED:
                    slots[:, 0] = 0
                yield pa.record_batch([
                    ids.take(pa.array(i + row)), pa.array(at - first[row]), pa.array(np.full(len(at), TEMPLATE if mode == LED else mode, np.int32)), pa.array(np.full(len(at), k, np.int32)),
                    pa.array(w[at].view(np.int64)), pa.ListArray.from_arrays(
                        pa.array(np.arange(0, k * len(at) + 1, k, dtype=np.int32)), pa.array(slots.ravel())),
                    pa.array(count[row])], names=["id", "pos", "mode", "size", "hash", "slots", "tokens"])


_SCHEMA = "id long, pos long, mode int, size int, hash long, slots array<long>, tokens long"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, cover, n_slots, kind): a row for each
    document and item of which it holds ``MIN_COVER`` of the windows or more with
    consistent slots, in the reading that covers most. kind is ``exact`` if each
    window found also stands there with the item's values, else ``changed``. An item of fewer than ``MIN_TOKENS`` tokens is
    found wherever its tokens stand in a row, however common they are. Null and empty
    texts, on either side, match nothing; an empty table on either side gives no rows.
    Several equal items each match; repeated ids count as one document."""
    spark: SparkSession = docs.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "decontam")
    items = benchmark.select(F.col(item_col).cast("long"), F.col(item_text).cast("string")).where(f"{item_col} IS NOT NULL")
    offered = [(m, k) for m in (TEMPLATE, FOLDED) for k in range(MIN_TOKENS, WINDOW + 1)] + [(PLAIN, k) for k in range(1, WINDOW + 1)]
    q = items.mapInArrow(lambda b: _windows(b, offered, None), _SCHEMA)
    q = scratch.save(q.where(f"size = least(tokens, {WINDOW})").selectExpr(
        "id AS item_id", "pos AS q_pos", "mode", "size", "hash", "slots AS q_slots"), "items")
    per_item = q.groupBy("item_id", "mode").agg(F.countDistinct("q_pos").alias("item_windows"))
    n = q.select("hash").distinct().limit(BROADCAST_WINDOWS + 1).count()
    used = sorted((r["mode"], r["size"]) for r in q.select("mode", "size").distinct().collect())
    used += [(LED, k) for m, k in used if m == TEMPLATE]
    sieve = None
    if n <= BROADCAST_WINDOWS:
        sieve = spark.sparkContext.broadcast(
            np.unique(np.array([r.hash for r in q.select("hash").distinct().collect()], np.int64).view(np.uint64)))
    src = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).where(F.col(id_col).isNotNull())
    hits = src.mapInArrow(lambda b: _windows(b, used, sieve.value if sieve else None), _SCHEMA) if n else \
        spark.createDataFrame([], _SCHEMA)
    small = F.broadcast(q) if n <= BROADCAST_WINDOWS // 20 else q
    joined = hits.join(small, ["hash", "size", "mode"])
    pairs = F.filter(F.arrays_zip("q_slots", "slots"), lambda x: x["q_slots"] != 0)
    joined = joined.withColumn("pairs", F.array_distinct(pairs))
    joined = joined.where(F.size(F.array_distinct(F.col("pairs.q_slots"))) == F.size("pairs"))
    joined = joined.withColumn("same", F.forall("pairs", lambda x: x["q_slots"] == x["slots"]))
    # an alignment (shift) has at most one value per token of the item: its slot pairs are bounded by the item
    runs = joined.withColumn("shift", F.expr("pos - q_pos")).groupBy("id", "item_id", "mode", "shift").agg(
        F.collect_set(F.struct("q_pos", "same")).alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    found = runs.select("id", "item_id", "mode", F.explode("at").alias("at"), F.size("pairs").alias("k"))
    found = found.groupBy("id", "item_id", "mode").agg(
        F.size(F.collect_set("at.q_pos")).cast("long").alias("n_windows"), F.max("k").cast("long").alias("n_slots"),
        F.size(F.collect_set(F.when(F.col("at.same"), F.col("at.q_pos")))).alias("n_same"))
    found = found.withColumn("same", F.col("n_same") == F.col("n_windows"))
    out = found.join(F.broadcast(per_item) if n <= BROADCAST_WINDOWS // 20 else per_item, ["item_id", "mode"])
    out = out.withColumn("cover", F.col("n_windows") / F.col("item_windows")).where(F.col("cover") >= MIN_COVER)
    row = F.struct("n_windows", "item_windows", "cover", "n_slots", F.when(F.col("same"), "exact").otherwise("changed").alias("kind"))
    best = out.groupBy(F.col("id").alias("doc_id"), "item_id").agg(F.max_by(row, F.struct("cover", -F.col("mode"))).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
