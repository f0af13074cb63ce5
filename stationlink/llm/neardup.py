"""MinHash near-duplicate detection with sequential Bayesian verification.

Five-word shingles, linked from a Jaccard similarity of 0.75. Steps:

1. Exact copies: documents of equal shingle sets form a class, known by a 128-bit hash
   of the set; only the smallest doc_id of a class goes on.
2. Banding: 40 bands of 5 min-hashes; representatives that share a band are candidates
   (a pair at similarity 0.75 shares none with probability 2e-5).
   The joins that make pairs also test ``PARITIES`` parity bits of the two sets, which
   bound the size of their difference from below: an exact test, whatever the bits are.
3. Candidates are compared signature batch by batch; a pair is dropped as soon as the
   posterior probability of reaching the threshold (uniform prior) is below
   ``MISS``.
4. Survivors are confirmed on their full shingle sets.
5. Components of the confirmed links. ``links.link_buckets`` keeps large groups of near
   copies from being paired with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, hash_words, mix, python_workers, text_slices, windows
from .links import link_buckets

SHINGLE = 5
BANDS, ROWS = 40, 5
BATCH = 40          # signature values compared before each look at the posterior
PARITIES = 512      # bits of a set's parity sketch, in words of 64
MISS = 1e-6         # posterior probability below which a candidate is dropped
BROADCAST_IDS = 500_000  # ids (8 bytes each) up to which a semi join broadcasts them

_rng = np.random.default_rng(8191)
_A = (_rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_SET1, _SET2 = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a slice. Fewer than k words: one
    shingle of the whole sequence; no word: none."""
    _, h, first = hash_words(buf, off)
    w = windows(h, k)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if n >= k:
            out.append(np.unique(w[a:b - k + 1]))
        elif n:
            out.append(mix(windows(h[a:b], n) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hash signatures (rows x hashes, uint32) of non-empty sets."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    sig = np.empty((len(_A), len(sets)), np.uint32)
    for i, (a, b) in enumerate(zip(_A, _B, strict=True)):
        np.minimum.reduceat(x * a + b, starts, out=sig[i])
    return np.ascontiguousarray(sig.T)


def _band_keys(sig: np.ndarray) -> np.ndarray:
    s = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2])
    for r in range(ROWS):
        key = mix(key * _SET1 + s[:, :, r])
    return key.view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for i, j, buf, off in text_slices(batch.column(1)):
            sets = shingle_sets(buf, off)
            n = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            keys = np.zeros((len(sets), BANDS), np.int64)
            if full:
                keys[n > 0] = _band_keys(signatures(full))
            bands = [k if m else [] for k, m in zip(keys, n, strict=True)]
            yield pa.record_batch([
                ids.slice(i, j - i), pa.array(n),
                pa.array([int(mix(s * _SET1).sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                pa.array([int(mix(s ^ _SET2).sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "c1", "c2", "bands"])


_WORDS = [f"w{i}" for i in range(PARITIES // 64)]
_SKETCH = pa.struct([(c, pa.int64()) for c in ["n", *_WORDS]])


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, ``PARITIES`` bits: whether an odd number of its shingles falls on each
    (rows x words, int64). Two sets differ in as many shingles as bits, or more."""
    cell = np.concatenate([i * PARITIES + (s % np.uint64(PARITIES)).astype(np.int64) for i, s in enumerate(sets)])
    odd = np.bincount(cell, minlength=len(sets) * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sets), -1), axis=1).view(np.int64)


def parity_bound(x: str, y: str, percent: int) -> str:
    """SQL of a condition on two sketches that holds where 100 * intersection >= percent *
    union: the difference then has at most (100 - percent) / (100 + percent) of the sum of
    the sizes."""
    bits = " + ".join(f"bit_count({x}.{c} ^ {y}.{c})" for c in _WORDS)
    return f"{100 + percent} * ({bits}) <= {100 - percent} * ({x}.n + {y}.n)"


def _load_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for i, j, buf, off in text_slices(batch.column(1)):
            sets = shingle_sets(buf, off)
            sig = signatures(sets)  # only rows with shingles come here
            words = [np.array([len(s) for s in sets], np.int64), *np.ascontiguousarray(parities(sets).T)]
            sketch = pa.StructArray.from_arrays([pa.array(w) for w in words], fields=list(_SKETCH))
            yield pa.record_batch([ids.slice(i, j - i), sketch, pa.array([s.tobytes() for s in sig], pa.binary()),
                                   pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "sketch", "sig", "shingles"])


def min_matches(threshold: float, miss: float, batch: int = BATCH, hashes: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """(values compared, matches needed): with fewer matches among the first n values the
    posterior P(similarity >= threshold) under a uniform prior is below ``miss``."""
    out = []
    for n in range(batch, hashes + 1, batch):
        p, m = 0.0, -1
        while p < miss and m < n:
            m += 1
            p += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _bayes(steps: list[tuple[int, int]]):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in (2, 3))
            live, m, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, need in steps:
                m = m + (a[live, done:n] == b[live, done:n]).sum(axis=1)
                live, m, done = live[m >= need], m[m >= need], n
            yield batch.select([0, 1]).take(pa.array(live))
    return keep


def _confirm(num: int, den: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if den * min(len(x), len(y)) < num * max(len(x), len(y)):
                    ok.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    return keep


def semi_by_id(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``: broadcast up to ``BROADCAST_IDS`` ids, a
    shuffled semi join above."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, on, "left_semi")


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Links documents with 100 * intersection >= percent * union of their shingle sets.
    Null or empty text has no shingle and no link (its component is itself). Equal sets
    are always linked. Ids must be unique; rows with a null id come back with null
    component and are kept. Other columns are ignored. An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "neardup")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    meta = scratch.save(src.mapInArrow(_describe, "doc_id long, n_shingles long, c1 long, c2 long, bands array<long>"), "meta")
    some = meta.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = scratch.save(some.groupBy("c1", "c2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    reps = some.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    band = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    shared = band.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    members = scratch.save(band.join(shared, "key").select("key", "id"), "members")
    ids = scratch.save(members.select(F.col("id").alias("doc_id")).distinct(), "ids")
    sets = scratch.save(semi_by_id(src, ids, "doc_id").mapInArrow(
        _load_sets, f"id long, sketch struct<{', '.join(f'{f.name}: bigint' for f in _SKETCH)}>, sig binary, shingles binary"), "sets")
    steps = min_matches(percent / 100, MISS)

    def verify(pairs: DataFrame) -> DataFrame:
        sig = sets.select("id", "sig")
        p = (pairs.join(sig.selectExpr("id AS a", "sig AS sa"), "a").join(sig.selectExpr("id AS b", "sig AS sb"), "b")
             .select("a", "b", "sa", "sb").mapInArrow(_bayes(steps), "a long, b long"))
        p = scratch.save(p, "survivors")
        full = sets.select("id", "shingles")
        return (p.join(full.selectExpr("id AS b", "shingles AS hb"), "b").join(full.selectExpr("id AS a", "shingles AS ha"), "a")
                .select("a", "b", "ha", "hb").mapInArrow(_confirm(percent, 100), "a long, b long"))

    comp, _ = link_buckets(members.join(sets.select("id", "sketch"), "id").select("key", "id", "sketch"), verify, scratch,
                           may=lambda x, y: parity_bound(x, y, percent))
    scratch.drop(members, ids, sets)
    top = classes.join(comp.select(F.col("id").alias("rep"), "comp"), "rep", "left").select(
        "c1", "c2", "n_shingles", F.coalesce("comp", "rep").alias("comp"))
    out = meta.select("doc_id", "n_shingles", "c1", "c2").join(top, ["c1", "c2", "n_shingles"], "left")
    comp_id = F.when(F.col("n_shingles") > 0, F.coalesce("comp", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", comp_id.alias("component_id"),
                      F.coalesce(comp_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import read
    return near_duplicates(read(spark, sf_dir, "documents"))
