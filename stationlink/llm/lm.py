"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and of word pairs over all training documents are quantised to
1 + floor(log2 count). An n-gram of level q is put into the filter under q keys, one per
level, so its level is read back by probing level 1, 2, ... until a probe fails. The
filter is built segment by segment (a segment holds the n-grams of one shard of the
counts) and holds every word and pair: it has ``BITS`` bits for each key, whose number
follows from a histogram of the levels. Up to ``BROADCAST_BITS`` it is broadcast; a
larger one is never put together: the n-grams of blocks of texts are sent to their
shards, probed there and sent back, with the exact counts of words that the base score
needs. Both ways give the same levels.

A pair's probability interpolates its share of the word before it with the smoothed
share of the word itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc_mod, hash_words, mix, python_workers, read, text_slices

BITS = 12              # of the filter for each key
PROBES = 3             # bits a key sets
BROADCAST_BITS = 1 << 25  # of the largest filter that is broadcast: 4 MB
BLOCK = 1 << 21        # bytes of text of which the n-grams are sent to the shards together
STEP = 1 << 17         # tokens of a block that are scored together
ASKED = 1 << 26        # bytes of requests that one task answers together
LEVELS = 48
HOT = 1 << 19          # a word of more than 1/HOT of all tokens is broadcast: at most HOT words
PAIR_SHARE = 0.3       # weight of the pair estimate
FLUSH = 2_000_000      # tokens a task counts before it hands counts on
END, BEGIN = np.uint64(0xE0D), np.uint64(0xB061)


def _sequence(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes with an end after each row, hash of each with the one before, first of
    each row + end)."""
    _, h, first = hash_words(buf, off)
    seq = np.insert(h, first[1:], END)
    first = first + np.arange(len(first))
    before = np.empty_like(seq)
    before[1:] = seq[:-1]
    before[first[:-1]] = BEGIN
    return seq, _pairs(before, seq), first


def _pairs(before: np.ndarray, seq: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x2545F4914F6CDD1D) + seq)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (((h >> np.uint64(40)) * np.uint64(shards)) >> np.uint64(24)).astype(np.int64)


def _cuts(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards present among sorted keys, and where each begins (+ end)."""
    s = _shard(keys, shards)
    at = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)]]) if len(s) else np.zeros(1, np.int64)
    return s[at[:-1]], at


def _pack(keys: np.ndarray) -> bytes:
    """The top 48 bits of sorted hashes of a shard: the first, then steps of 32 bits; all in
    6 bytes if a step is too long for that."""
    k = keys >> np.uint64(16)
    steps = np.diff(k)
    if len(steps) and int(steps.max()) >> 32:
        return b"\0" + np.ascontiguousarray(k.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
    return b"\1" + k[:1].tobytes() + steps.astype(np.uint32).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    if b[:1] == b"\1":
        first = np.frombuffer(b[1:9], np.uint64)
        return np.cumsum(np.concatenate([first, np.frombuffer(b[9:], np.uint32).astype(np.uint64)]), dtype=np.uint64)
    out = np.zeros(((len(b) - 1) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b[1:], np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _pack_counts(n: np.ndarray) -> bytes:
    """A byte for each count; 255 stands for a larger one, which follows at the end."""
    large = n[n >= 255].astype(np.uint64)
    return np.minimum(n, 255).astype(np.uint8).tobytes() + large.tobytes()


def _unpack_counts(b: bytes, size: int) -> np.ndarray:
    n = np.frombuffer(b[:size], np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(b[size:], np.uint64).astype(np.int64)
    return n


def _count(shards: int):
    def flush(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows = []
        for order, parts in enumerate(held, 1):
            if parts:
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                ids, at = _cuts(keys, shards)
                for s, a, b in zip(ids, at[:-1], at[1:], strict=True):
                    k = keys[a:b]
                    rows.append((order, int(s), k.tobytes() if order == 1 else _pack(k), _pack_counts(n[a:b])))
            parts.clear()
        for i in range(0, len(rows), 256):
            cols = list(zip(*rows[i:i + 256], strict=True))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                                  names=["order", "shard", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]
        size = 0
        for batch in batches:
            for _, _, buf, off in text_slices(batch.column(0), 1 << 20):
                seq, pair, _ = _sequence(buf, off)
                held[0].append(seq)
                held[1].append(pair)
                size += len(seq)
                if size >= FLUSH:
                    yield from flush(held)
                    size = 0
        yield from flush(held)
    return run


def _reduce(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums the counts of one shard. Of words the counts are kept, of pairs their levels (a byte)."""
    order = int(key[0])
    read_keys = (lambda b: np.frombuffer(b, np.uint64)) if order == 1 else _unpack
    k = [read_keys(b) for b in pdf["keys"]]
    n = np.concatenate([_unpack_counts(b, len(x)) for b, x in zip(pdf["counts"], k, strict=True)])
    keys, at = np.unique(np.concatenate(k), return_inverse=True)
    n = np.bincount(at, n, len(keys)).astype(np.int64)
    tokens, distinct = int(n.sum()), len(keys)
    level = np.frexp(n.astype(np.float64))[1]
    return pd.DataFrame({"order": [order], "shard": [int(key[1])], "keys": [keys.tobytes() if order == 1 else _pack(keys << np.uint64(16))],
                         "counts": [n.tobytes() if order == 1 else level.astype(np.uint8).tobytes()], "tokens": [tokens],
                         "distinct": [distinct], "levels": [np.bincount(level, minlength=LEVELS + 1)[:LEVELS + 1].tolist()]})


def _levels_of(order: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys (the top 48 bits of the hashes) and levels of a row of the counts."""
    if order == 1:
        return np.frombuffer(keys, np.uint64) >> np.uint64(16), np.frexp(np.frombuffer(counts, np.int64).astype(np.float64))[1]
    return _unpack(keys), np.frombuffer(counts, np.uint8).astype(np.int64)


def _probe_bits(k48: np.ndarray, order: int, level: int, bits: int) -> np.ndarray:
    """Places (rows x PROBES) in a segment of a key's level."""
    g = mix(k48 * np.uint64(2) + np.uint64((order - 1 + level * 0xD6E8FEB86659FD93) % (1 << 64)))
    step = (g >> np.uint64(32)) | np.uint64(1)
    return ((g + np.arange(PROBES, dtype=np.uint64)[:, None] * step) % np.uint64(bits)).astype(np.int64).T


def _segment(bits: int, least: int = 1):
    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(bits, bool)
        for order, keys, counts in zip(pdf["order"], pdf["keys"], pdf["counts"], strict=True):
            k, level = _levels_of(int(order), keys, counts)
            k, level = k[level >= least], level[level >= least]
            for q in range(1, int(level.max(initial=0)) + 1):
                table[_probe_bits(k[level >= q], int(order), q, bits).ravel()] = True
        return pd.DataFrame({"shard": [int(key[0])], "bits": [np.packbits(table).tobytes()]})
    return build


class LogFrequencyFilter:
    """Reads quantised counts back."""

    def __init__(self, table: np.ndarray, shards: int, bits: int):
        self.table, self.shards, self.bits = table, shards, bits

    def levels(self, h: np.ndarray, order: int) -> np.ndarray:
        return self.of_keys(h >> np.uint64(16), _shard(h, self.shards) * self.bits, order)

    def of_keys(self, k: np.ndarray, base: np.ndarray, order: int) -> np.ndarray:
        out, live = np.zeros(len(k), np.int64), np.arange(len(k))
        for q in range(1, LEVELS + 1):
            if not len(live):
                break
            pos = base[live][:, None] + _probe_bits(k[live], order, q, self.bits)
            live = live[(self.table[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8) & 1).all(axis=1)]
            out[live] = q
        return out


def _log_prob(word_level: np.ndarray, pair_level: np.ndarray, first: np.ndarray, n: int, vocab: int, begins: int) -> np.ndarray:
    """log10 of PAIR_SHARE * pair / before + the rest * (word + 1) / (n + vocab + 1). A level q
    stands for 2^(q-1) above a fraction and for 2^q - 1 below it, so that the shares of the
    words after a context do not exceed 1."""
    cu, cp = (np.where(x > 0, 2.0 ** (x - 1), 0.0) for x in (word_level, pair_level))
    most = np.maximum(2.0 ** word_level - 1, 0.0)
    before = np.empty_like(cu)
    before[1:] = most[:-1]
    before[first[:-1]] = begins
    word = (cu + 1) / (n + vocab + 1)
    share = np.where(before > 0, np.minimum(cp / np.maximum(before, 1), 1.0), 0.0)
    return np.log10(np.where(before > 0, (1 - PAIR_SHARE) * word + PAIR_SHARE * share, word))


_ROW = ["doc_id", "held_out", "n_tokens", "known", "part", "score", "rare"]


def _rows(ids: pa.Array, held: pa.Array, seq: np.ndarray, first: np.ndarray, log_prob: np.ndarray, hot_keys: np.ndarray,
          hot_counts: np.ndarray, unit: float) -> list[pa.Array]:
    """The columns ``_ROW`` of the texts of a sequence."""
    score = np.add.reduceat(log_prob, first[:-1])
    near = np.minimum(np.searchsorted(hot_keys, seq), max(len(hot_keys) - 1, 0))
    is_hot = hot_keys[near] == seq if len(hot_keys) else np.zeros(len(seq), bool)
    part = np.where(is_hot, np.log10((hot_counts[near] if len(hot_keys) else np.zeros(len(seq))) + 1.0) - unit, 0.0)
    rows = np.searchsorted(first, np.flatnonzero(~is_hot), "right") - 1
    words = seq[~is_hot]
    cut = np.searchsorted(rows, np.arange(len(ids) + 1))
    rare = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(words.view(np.int64)))
    return [ids, held, pa.array(np.diff(first)), pa.array(np.add.reduceat(is_hot.astype(np.int64), first[:-1])),
            pa.array(np.add.reduceat(part, first[:-1])), pa.array(score), rare]


def _hot_tables(tables) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(tables.value[0], np.uint64), np.frombuffer(tables.value[1], np.int64)


def _score(filter_bytes, tables, shards: int, bits: int, n: int, vocab: int, begins: int, unit: float):
    """Scores texts with the whole filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filt = LogFrequencyFilter(np.frombuffer(filter_bytes.value, np.uint8), shards, bits)
        hot = _hot_tables(tables)
        for batch in batches:
            for i, j, buf, off in text_slices(batch.column(1), 1 << 21):
                seq, pair, first = _sequence(buf, off)
                (u, at), (p, at2) = (np.unique(x, return_inverse=True) for x in (seq, pair))
                log_prob = _log_prob(filt.levels(u, 1)[at], filt.levels(p, 2)[at2], first, n, vocab, begins)
                yield pa.record_batch(_rows(batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), seq, first, log_prob, *hot, unit),
                                      names=_ROW)
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in blocks of about ``BLOCK`` bytes: a row (block, ids, held, texts)."""
    number, size = TaskContext.get().partitionId() << 32, 0
    held: list[list[pa.Array]] = []

    def block() -> pa.RecordBatch:
        cols = [pa.concat_arrays(c) for c in zip(*held, strict=True)]
        ends = pa.array([0, len(cols[0])], pa.int32())
        return pa.record_batch([pa.array([number]), *(pa.ListArray.from_arrays(ends, c) for c in cols)], names=["block", "ids", "held", "texts"])

    for batch in batches:
        for i, j, buf, _ in text_slices(batch.column(1), BLOCK):
            cols = [batch.column(c).slice(i, j - i) for c in (0, 2, 1)]
            held.append([*cols[:2], pc.fill_null(cols[2], "").cast(pa.string())])
            size += len(buf)
            if size >= BLOCK:
                yield block()
                number, size = number + 1, 0
                held.clear()
    if held:
        yield block()


def _block_sequence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_sequence`` of all texts of a block, made a megabyte at a time."""
    seq, pair, first, n = [], [], [np.zeros(1, np.int64)], 0
    for _, _, buf, off in text_slices(texts, 1 << 20):
        s, p, f = _sequence(buf, off)
        seq.append(s)
        pair.append(p)
        first.append(n + f[1:])
        n += len(s)
    return np.concatenate(seq), np.concatenate(pair), np.concatenate(first)


def _ask(shards: int, parts: int):
    """For each block and shard, the distinct words (order 1) and pairs (order 2) of its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = batch.column(0)[r].as_py()
                seq, pair, _ = _block_sequence(batch.column(1).slice(r, 1).flatten())
                order, shard, keys = [], [], []
                for o, x in enumerate((seq, pair), 1):
                    u = np.unique(x)
                    present, at = _cuts(u, shards)
                    for s, a, b in zip(present, at[:-1], at[1:], strict=True):
                        order.append(o)
                        shard.append(int(s))
                        keys.append(u[a:b].tobytes() if o == 1 else _pack(u[a:b]))
                yield pa.record_batch([pa.array([block] * len(order), pa.int64()), pa.array(order, pa.int32()), pa.array(shard, pa.int32()),
                                       pa.array([block % parts] * len(order), pa.int32()), pa.array(keys, pa.binary())],
                                      names=["block", "order", "shard", "part", "keys"])
    return run


def _answer(bits: int):
    """Levels of the n-grams asked of one shard, and of words the counts."""
    def run(key: tuple, counts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked):
            filt = LogFrequencyFilter(np.frombuffer(_segment(bits)(key, counts)["bits"][0], np.uint8), 1, bits)
            word = counts[counts["order"] == 1]
            word = [(np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)) for k, c in zip(word["keys"], word["counts"], strict=True)]
            known, n = word[0] if word else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for order, part in asked.groupby("order"):
                k = [np.frombuffer(b, np.uint64) if order == 1 else _unpack(b) for b in part["keys"]]
                every = np.concatenate(k)
                cut = np.cumsum([len(x) for x in k])[:-1]
                top = every >> np.uint64(16) if order == 1 else every
                level = np.split(filt.of_keys(top, np.zeros(len(top), np.int64), int(order)).astype(np.uint8), cut)
                exact = [b""] * len(k)
                if order == 1:
                    at = np.minimum(np.searchsorted(known, every), max(len(known) - 1, 0))
                    found = np.where(known[at] == every, n[at], 0) if len(known) else np.zeros(len(every), np.int64)
                    exact = [_pack_counts(x) for x in np.split(found, cut)]
                out.append(pd.DataFrame({"block": part["block"].to_numpy(), "order": int(order), "shard": int(key[0]),
                                         "levels": [x.tobytes() for x in level], "counts": exact}))
        return pd.concat(out) if out else pd.DataFrame({"block": [], "order": [], "shard": [], "levels": [], "counts": []})
    return run


def _finish(n: int, vocab: int, begins: int, unit: float):
    """Scores the texts of one block with the answers of all shards."""
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        ids, held, texts = (block.column(c).combine_chunks().flatten() for c in ("ids", "held", "texts"))
        *grams, first = _block_sequence(texts)
        # a shard is a range of hashes: its answers in order of the shards are in order of the hashes
        answers = answers.sort_by([("order", "ascending"), ("shard", "ascending")])
        order = answers.column("order").to_numpy()
        level = []
        for o in (1, 2):
            mine = answers.filter(pa.array(order == o))
            got = mine.column("levels").to_pylist()
            at = np.unique(grams.pop(0), return_inverse=True)[1]
            level.append(np.frombuffer(b"".join(got), np.uint8)[at])
            if o == 1:
                count = np.concatenate([_unpack_counts(c, len(q)) for c, q in zip(mine.column("counts").to_pylist(), got, strict=True)])[at]
        sums, i = [[], [], []], 0
        while i < len(first) - 1:
            # whole texts of about ``STEP`` tokens together
            j = max(i + 1, int(np.searchsorted(first, first[i] + STEP, "right")) - 1)
            part, cut = slice(first[i], first[j]), first[i:j + 1] - first[i]
            log_prob = _log_prob(*(x[part].astype(np.int64) for x in level), cut, n, vocab, begins)
            for out, x in zip(sums, (np.log10(count[part] + 1.0) - unit, log_prob, (count[part] > 0).astype(np.int64)), strict=True):
                out.append(np.add.reduceat(x, cut[:-1]))
            i = j
        sums = [np.concatenate(x) for x in sums]
        return pa.table([ids, held, pa.array(np.diff(first)), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1])], names=_ROW[:-1])
    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts as rows."""
    for batch in batches:
        for keys, counts in zip(batch.column(0), batch.column(1), strict=True):
            yield pa.record_batch([pa.array(np.frombuffer(keys.as_buffer(), np.int64)), pa.array(np.frombuffer(counts.as_buffer(), np.int64))],
                                  names=["word", "c"])


def _hot(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _spread(batches):
            yield batch.filter(pa.array(batch.column(1).to_numpy() > least))
    return run


@contextmanager
def _one_block(spark: SparkSession):
    """While it lasts, a task reads and hands on one block of texts at a time, not all
    blocks of its partition together."""
    new = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BLOCK), "spark.sql.parquet.enableNestedColumnVectorizedReader": "false"}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.
    Learns from rows whose crc32(id) mod 7 is not 2. Null text is empty: one end token.
    Repeated ids each get their own row; a null id is not held out. Without a training
    row all counts are 0. Words are told apart by 64-bit hashes."""
    spark = docs.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "lm")
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumn("held_out", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)))
    train = src.where("NOT held_out")
    counts = scratch.save(
        train.select("text").mapInArrow(_count(shards), "order int, shard int, keys binary, counts binary").groupBy("order", "shard")
        .applyInPandas(_reduce, "order int, shard int, keys binary, counts binary, tokens long, distinct long, levels array<long>"), "counts")
    totals = {r.order: r for r in counts.groupBy("order").agg(
        F.sum("tokens").alias("n"), F.sum("distinct").alias("v"),
        F.array(*[F.sum(F.element_at("levels", q + 1)) for q in range(LEVELS + 1)]).alias("levels")).collect()}
    n, v = (totals[1].n, totals[1].v) if 1 in totals else (0, 0)
    hist = np.sum([t.levels for t in totals.values()], axis=0) if totals else np.zeros(LEVELS + 1)
    bits = max(-(-int((hist * np.arange(LEVELS + 1)).sum()) * BITS // (8 * shards)) * 8, 512)
    grams = counts.select("shard", "order", "keys", "counts")
    words = counts.where("order = 1").select("keys", "counts")
    hot = words.mapInArrow(_hot(n / HOT), "word long, c long").toArrow()
    hot_keys = hot.column("word").to_numpy().view(np.uint64)
    order = np.argsort(hot_keys)
    tables = spark.sparkContext.broadcast((hot_keys[order].tobytes(), hot.column("c").to_numpy()[order].tobytes()))
    begins = train.count()
    base_unit = float(np.log10(float(n) + v + 1.0))
    done = "doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score".split(", ")
    scratch.free()
    row = f"doc_id {kind}, held_out boolean, n_tokens long, known long, part double, score double, rare array<long>"
    texts = src.select("doc_id", "text", "held_out")
    if shards * bits > BROADCAST_BITS:
        row = row.removesuffix(", rare array<long>")
        blocks = scratch.save(texts.mapInArrow(_blocks, f"block long, ids array<{kind}>, held array<boolean>, texts array<string>"), "blocks")
        # a shard with many requests is answered in parts
        parts = 1 + 5 * n // (shards * ASKED)
        asked = blocks.select("block", "texts").mapInArrow(_ask(shards, parts), "block long, order int, shard int, part int, keys binary")
        held = grams.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        answers = held.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInPandas(
            _answer(bits), "block long, order int, shard int, levels binary, counts binary")
        # the answers are written, so that the requests (several times as large) are gone before texts are shuffled
        with _one_block(spark):
            answers = scratch.save(answers, "answers")
            scratch.drop(counts)
            scored = scratch.save(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_finish(n, v, begins, base_unit), row), "scored")
        scratch.drop(blocks, answers)
        out = scored.withColumnsRenamed({"known": "n_known", "part": "base_score"}).withColumn("train_tokens", F.lit(int(n)).cast("long"))
        return out.select(*done)
    table = np.zeros(shards * bits // 8, np.uint8)
    for r in grams.groupBy("shard").applyInPandas(_segment(bits), "shard int, bits binary").toLocalIterator():
        table[r.shard * bits // 8:(r.shard + 1) * bits // 8] = np.frombuffer(r.bits, np.uint8)
    scored = texts.mapInArrow(_score(spark.sparkContext.broadcast(table.tobytes()), tables, shards, bits, n, v, begins, base_unit), row)
    per = scratch.save(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    # the exact counts of the other words by a join; each of them is at most 1/HOT of all tokens
    unit = F.lit(base_unit)
    rare = per.select("row", F.explode("rare").alias("word"))
    cold = words.mapInArrow(_spread, "word long, c long").where(F.col("c") <= n / HOT)
    rest = rare.join(cold, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1.0) - unit).alias("rest"), F.count("c").alias("more"))
    out = per.drop("rare").join(rest, "row", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(int(n)).cast("long").alias("train_tokens"),
                      (F.col("part") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))
