"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer
network with temperature-calibrated probabilities.

Random indexing: each of ``BUCKETS`` token buckets has a fixed sparse ternary index
vector; a bucket's context vector is the sum of the index vectors of the tokens around
its occurrences, over all documents. A document is the mean of its tokens' context
vectors and the mean elementwise product of neighbours (which shows repetition). The
vector table has a fixed size (4 MB); the network is fitted on at most ``SAMPLE``
labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _VAL, Scratch, _powers, crc_mod, mix, python_workers, read, text_slices

BUCKETS = 1 << 15
DIM = 32
REACH = 2          # tokens to each side that count as context
SAMPLE = 20_000    # labelled documents, those with the smallest crc32 of their id
HIDDEN, EPOCHS, RATE = 32, 300, 0.01
CUT = 0.3          # score from which a document is predicted good

_CLS = np.full(256, 3, np.uint8)   # kinds of bytes: letters, digits, signs; 0 is white space
_CLS[[0x20, *range(0x09, 0x0E)]] = 0
_CLS[128:] = 1
_CLS[65:91] = _CLS[97:123] = 1
_CLS[48:58] = 2
_TOKEN = np.where(_CLS > 0, _VAL, 0).astype(np.uint64)


def index_vectors() -> np.ndarray:
    """DIM x (BUCKETS + 1): four entries of +1 or -1 per bucket; the last bucket is none."""
    rng = np.random.default_rng(99)
    out = np.zeros((BUCKETS + 1, DIM), np.float32)
    at = rng.permuted(np.tile(np.arange(DIM), (BUCKETS, 1)), axis=1)[:, :4]
    out[np.arange(BUCKETS)[:, None], at] = rng.choice([-1, 1], (BUCKETS, 4))
    return np.ascontiguousarray(out.T)


def buckets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token, first token of each row + end): tokens are runs of letters,
    of digits or of signs."""
    n = len(buf)
    cls = _CLS[buf]
    start = cls > 0
    start[1:] &= cls[1:] != cls[:-1]
    rows = off[:-1][off[:-1] < n]
    start[rows] = cls[rows] > 0
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    up, down = _powers(n)
    h = mix(np.add.reduceat(_TOKEN[buf] * up[:n], starts) * down[starts])
    return (h >> np.uint64(49)).astype(np.int64), np.searchsorted(starts, off)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = index_vectors()
    total = np.zeros((DIM, BUCKETS + 1))
    for batch in batches:
        for _, _, buf, off in text_slices(batch.column(0), 1 << 20):
            b, first = buckets(buf, off)
            if not len(b):
                continue
            # REACH empty tokens between documents keep contexts apart
            gaps = np.repeat(first[1:], REACH)
            b = np.concatenate([np.full(REACH, BUCKETS), np.insert(b, gaps, BUCKETS)])
            for d in range(DIM):
                x = index[d][b]
                near = np.zeros(len(b), np.float32)
                for k in range(1, REACH + 1):
                    near[k:] += x[:-k]
                    near[:-k] += x[k:]
                total[d] += np.bincount(b, near, BUCKETS + 1)
    at = np.flatnonzero(np.abs(total[:, :BUCKETS]).sum(axis=0))
    yield pa.record_batch([pa.array(at)] + [pa.array(total[d, at]) for d in range(DIM)],
                          names=["bucket"] + [f"v{d}" for d in range(DIM)])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """DIM x (BUCKETS + 1) context vectors of unit length from the one text column: a sum per
    bucket, of which at most BUCKETS rows come to the driver."""
    cols = ", ".join(f"v{d} double" for d in range(DIM))
    sums = texts.mapInArrow(_contexts, f"bucket long, {cols}").groupBy("bucket").agg(
        *[F.sum(f"v{d}").alias(f"v{d}") for d in range(DIM)])
    out = np.zeros((DIM, BUCKETS + 1), np.float32)
    for r in sums.toArrow().to_batches():
        at = r.column(0).to_numpy()
        out[:, at] = np.stack([r.column(d + 1).to_numpy() for d in range(DIM)])
    return out / np.maximum(np.sqrt((out ** 2).sum(axis=0)), 1e-9)


def _pool(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(vectors.value, np.float32).reshape(DIM, BUCKETS + 1)
        for batch in batches:
            for i, j, buf, off in text_slices(batch.column(1), 1 << 20):
                b, first = buckets(buf, off)
                n = np.diff(first)
                out = np.zeros((j - i, 2 * DIM + 1), np.float32)
                rows = np.flatnonzero(n)
                if len(rows):
                    starts = first[:-1][rows]
                    inner = np.ones(len(b), np.float32)   # 0 at the last token of a row: its neighbour is in another
                    inner[first[1:][rows] - 1] = 0
                    for d in range(DIM):
                        x = table[d][b]
                        out[rows, d] = np.add.reduceat(x, starts) / n[rows]
                        x[:-1] *= x[1:]
                        out[rows, DIM + d] = np.add.reduceat(x * inner, starts) / np.maximum(n[rows] - 1, 1)
                    out[:, 2 * DIM] = n > 0
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                                       pa.array([r.tobytes() for r in out], pa.binary())], names=["doc_id", "held_out", "x"])
    return run


def train(x: np.ndarray, y: np.ndarray) -> dict:
    """Two-layer network (tanh) by Adam on four fifths of the rows, temperature on the rest."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / sd, -8, 8)
    held = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.zeros(len(y), bool)
    a, t = z[~held], y[~held]
    rng = np.random.default_rng(3)
    p = [rng.normal(0, 1 / np.sqrt(a.shape[1]), (a.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for step in range(1, EPOCHS + 1):
        h = np.tanh(a @ p[0] + p[1])
        g = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - t) / len(t)
        back = np.outer(g, p[2]) * (1 - h * h)
        grads = [a.T @ back + 1e-5 * p[0], back.sum(axis=0), h.T @ g + 1e-5 * p[2], np.array([g.sum()])]
        for k, d in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.999 * v[k] + 0.001 * d * d
            p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    model = {"mean": mean, "sd": sd, "p": p, "t": 1.0}
    if held.any():
        z1 = logits(model, x[held])
        temps = np.geomspace(0.1, 10, 50)
        loss = [np.mean(np.logaddexp(0, z1 / k) - y[held] * z1 / k) for k in temps]
        model["t"] = float(temps[int(np.argmin(loss))])
    return model


def logits(model: dict, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = model["p"]
    return np.tanh(np.clip((x - model["mean"]) / model["sd"], -8, 8) @ w1 + b1) @ w2 + b2


def _score(model: dict | None, base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            s = np.full(n, base)
            if model is not None and n:
                x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(n, -1)
                s = 1 / (1 + np.exp(-np.clip(logits(model, x) / model["t"], -50, 50)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                                  names=["doc_id", "held_out", "score", "predicted"])
    return run


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``. Labels of documents of
    crc32(id) mod 5 = 0 are never learned from; a document labelled twice takes the larger
    label; null ids and labels are not learned from. Without labels of both kinds the
    score is the share of good ones (0.5 without any). Null and empty text is scored like
    any other, from an all-zero vector."""
    spark = docs.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "classifier")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumn("held_out", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)))
    vectors = spark.sparkContext.broadcast(word_vectors(src.select("text")).tobytes())
    pooled = scratch.save(src.select("doc_id", "text", "held_out").mapInArrow(
        _pool(vectors), f"doc_id {src.schema['doc_id'].dataType.simpleString()}, held_out boolean, x binary"), "pooled")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    known = known.where(crc_mod("doc_id", 5) != 0)
    known = known.orderBy(F.crc32(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(SAMPLE)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = pooled.where("NOT held_out").join(F.broadcast(known), "doc_id").select("doc_id", "x", "y").orderBy("doc_id", "x").limit(SAMPLE).collect()
    y = np.array([1.0 if r.y > 0 else 0.0 for r in rows])
    base = float(y.mean()) if len(y) else 0.5
    model = None
    if len(set(y)) == 2:
        x = np.stack([np.frombuffer(r.x, np.float32) for r in rows])
        order = np.random.default_rng(1).permutation(len(y))
        model = train(x[order].astype(np.float64), y[order])
    return pooled.mapInArrow(_score(model, base), f"doc_id {src.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
