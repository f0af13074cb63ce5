"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams (1 to 3), trained with follow-the-regularised-leader (elastic net), then
temperature calibration.

Document frequencies are counted over all labelled documents. The regression is fitted on
a sample of about ``SAMPLE`` of them, spread evenly over all languages, or of about
``LEAST`` a language if that is more; sampled rows are those with the smallest hash of
their id. A text's term frequencies are its n-gram
counts over their number, so its scores are means over its n-grams, and whole texts of
any length are scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, python_workers, read

DIMS = 1 << 14
SAMPLE = 3000
LEAST = 10       # rows of a language, where there are so many
SCALE = 30.0     # of the TF-IDF values
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 1e-4, 1e-5, 5
SLICE = 1 << 18  # characters worked on at once

_LUT = np.array([c if chr(c).isalpha() else 32 for c in range(0x250)], np.uint32)
_MULS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets (3 x characters; DIMS: none), first character of each text). Letters are
    lowered, other characters below U+0250 count as space."""
    joined = "\x00\x00".join(t.lower().replace("\x00", " ") for t in texts) + "\x00\x00"
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    end = c == 0
    stops = np.flatnonzero(end)[1::2]
    starts = np.concatenate([[0], stops[:-1] + 1])
    c = np.where(c < 0x250, _LUT[np.minimum(c, 0x24F)], c)
    pad = np.concatenate([c, c[-2:]])
    out = np.empty((3, len(c)), np.int32)
    h = np.zeros(len(c), np.uint32)
    for k in range(3):
        h = (h ^ pad[k:k + len(c)]) * _MULS[k]
        h ^= h >> np.uint32(15)
        out[k] = (h * np.uint32(0x27D4EB2F)) >> np.uint32(18)
    out[:, end] = DIMS
    return out, starts


def _parts(col: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about ``SLICE`` characters, with the first row of each."""
    run, first, size = [], 0, 0
    for i, x in enumerate(col):
        t = x.as_py() or ""
        run.append(t)
        size += len(t)
        if size >= SLICE:
            yield first, run
            run, first, size = [], i + 1, 0
    if run:
        yield first, run


def _doc_freq(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(DIMS + 1, np.int64), 0
    for batch in batches:
        for _, texts in _parts(batch.column(0)):
            g, starts = _grams(texts)
            for a, b in zip(starts, [*starts[1:], g.shape[1]], strict=True):
                seen = np.zeros(DIMS + 1, bool)
                seen[g[:, a:b]] = True
                total += seen
            docs += len(texts)
    total[DIMS] = docs
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for first, texts in _parts(batch.column(1)):
            g, starts = _grams(texts)
            for k, (a, b) in enumerate(zip(starts, [*starts[1:], g.shape[1]], strict=True)):
                n = np.bincount(g[:, a:b].ravel(), minlength=DIMS + 1)[:DIMS]
                at = np.flatnonzero(n)
                rows.append((batch.column(0)[first + k].as_py(), at.astype(np.uint16).tobytes(),
                             (n[at] / max(n.sum(), 1)).astype(np.float32).tobytes()))
        yield pa.record_batch([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.binary(), pa.binary()))],
                              names=["lang", "at", "tf"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=0))
    return e / e.sum(axis=0)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights classes x DIMS, biases, temperature) of (class, buckets, values) rows: every
    fifth calibrates, the others train."""
    z, n, w = (np.zeros((classes, DIMS + 1)) for _ in range(3))
    fit = [r for i, r in enumerate(rows) if i % 5] or rows
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            y, at, x = fit[i]
            at, x = np.append(at, DIMS), np.append(x, 1.0)
            zi, ni = z[:, at], n[:, at]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = _softmax(wi @ x)
            p[y] -= 1
            g = p[:, None] * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[:, at] += g - sigma * wi
            n[:, at] += g * g
            w[:, at] = wi
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    held = [r for i, r in enumerate(rows) if i % 5 == 0]
    logits = np.array([w[:, at] @ x + w[:, DIMS] for _, at, x in held])
    y = np.array([r[0] for r in held])
    loss = [(-np.log(np.maximum(_softmax(logits.T / t)[y, np.arange(len(y))], 1e-12)).mean(), t) for t in np.geomspace(0.05, 20, 60)]
    return w[:, :DIMS], w[:, DIMS], min(loss)[1]


def _predict(langs: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
    import regex

    letter = regex.compile(r"\p{L}")
    w = np.concatenate([weights, np.zeros((len(langs), 1), weights.dtype)], axis=1) if langs else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = [], []
            for _, texts in _parts(batch.column(1)):
                has = [letter.search(t) is not None for t in texts]
                if not langs:
                    pred += ["und"] * len(texts)
                    score += [0.0] * len(texts)
                    continue
                g, starts = _grams(texts)
                n = np.add.reduceat((g[0] < DIMS).astype(np.int64), starts) * 3
                z = np.stack([sum(np.add.reduceat(wc[g[k]], starts) for k in range(3)) for wc in w]) / np.maximum(n, 1) + bias[:, None]
                p = _softmax(z / temperature)
                best = p.argmax(axis=0)
                pred += [langs[b] if ok else "und" for b, ok in zip(best, has, strict=True)]
                score += [float(x) if ok else 0.0 for x, ok in zip(p.max(axis=0), has, strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                  names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row: the likeliest learned language
    and its calibrated probability. Rows of crc32(id) mod 5 = 0 (held out), and null
    languages, are not learned from. Null text and text without a letter are ``und`` with
    score 0, and so is everything if there is nothing to learn from; ties go to the
    language that sorts first. A null id is not held out and not learned from."""
    spark = docs.sparkSession
    python_workers(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    src = src.withColumn("held_out", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)))
    learn = src.where("NOT held_out AND lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    freq = dict(learn.select("text").mapInArrow(_doc_freq, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect())
    counts = {r.lang: r["count"] for r in learn.groupBy("lang").count().collect()}
    langs = sorted(counts)
    weights, bias, temperature = np.zeros((0, DIMS)), np.zeros(0), 1.0
    if langs:
        idf = np.log((1 + freq.get(DIMS, 0)) / (1 + np.array([freq.get(i, 0) for i in range(DIMS)]))) + 1
        each = max(SAMPLE // len(langs), LEAST)
        # each row's hash against its language's share; the limit cuts what chance adds
        u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
        share = F.create_map(*[x for g, n in counts.items() for x in (F.lit(g), F.lit(each / n))])
        sample = learn.where(u < share[F.col("lang")]).select("lang", "text", F.xxhash64("doc_id").alias("o"))
        picked = sample.select("lang", "text").mapInArrow(_features, "lang string, at binary, tf binary")
        rows = []
        for r in picked.limit(2 * max(SAMPLE, each * len(langs))).collect():
            at = np.frombuffer(r.at, np.uint16).astype(np.int64)
            rows.append((r.at, r.tf, langs.index(r.lang), at, np.frombuffer(r.tf, np.float32) * idf[at] * SCALE))
        rows.sort(key=lambda r: (r[2], r[0], r[1]))
        order = np.random.default_rng(5).permutation(len(rows))
        weights, bias, temperature = train([rows[i][2:] for i in order], len(langs))
        weights = weights * idf * SCALE
    run = _predict(langs, weights.astype(np.float32), bias, temperature)
    return src.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
