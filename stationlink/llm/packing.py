"""Bounded-space online packing of tokenised documents into sequences.

Each partition keeps ``OPEN`` windows. A document's whole sequences of ``SIZE`` ids are
emitted at once; what is left goes to the open window that it fits best. If it fits none
and all windows are in use, the fullest one is filled with a first cut of it (if at least
``MIN_CUT`` ids fit) and emitted. The windows that are still open at the end of a
partition are merged, a fixed number of partitions at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, python_workers, read

SIZE = 2048
OPEN = 16
MIN_CUT = 16
EOD = 1
MERGE = 64             # partitions whose leftovers are merged together
CACHE_ENTRIES = 1_000_000  # words whose ids a worker remembers

# how the byte-level tokenizer cuts text before merging, and white space besides space and \n
# (fixed values)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


class Encoder(dict):
    """Ids of whole texts as little-endian 32-bit bytes, equal to the tokenizer's own.

    A byte-level BPE tokenizer starts a new piece at each space between non-spaces, so the
    ids of a text without other white space beside a space are those of its words, each
    with the space before it; they are remembered (up to ``CACHE_ENTRIES``; this dict).
    Words are encoded from the tokenizer's own vocabulary, whose ids are its merge ranks.
    Other texts, and such with a special token, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(byte[c] for c in w): i for w, i in vocab.items() if w not in special}
        self.special = sorted(special)
        self.words = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = ids = np.array(self.words.encode_ordinary(" " + word), "<u4").tobytes()
        return ids

    def ids(self, text: str) -> bytes:
        if "  " in text or " \n" in text or "\n " in text or any(c in text for c in OTHER_SPACE) or any(t in text for t in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.split(" ")
        head = np.array(self.words.encode_ordinary(words[0]), "<u4").tobytes()
        return head + b"".join([self[w] for w in words[1:]])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """Open windows of one partition. ``add`` returns the finished pieces."""

    def __init__(self, size: int = SIZE, slots: int = OPEN, min_cut: int = MIN_CUT):
        self.size, self.slots, self.min_cut = size, slots, min_cut
        self.open: list[tuple[int, int]] = []  # (used, sequence)
        self.sequences = 0
        self.closed: set[int] = set()

    def _new(self) -> int:
        self.sequences += 1
        return self.sequences - 1

    def add(self, n: int) -> list[tuple[int, int, int, int]]:
        """Pieces (start, length, sequence, offset) of a document of n ids."""
        out, start = [], 0
        while n - start >= self.size:
            s = self._new()
            self.closed.add(s)
            out.append((start, self.size, s, 0))
            start += self.size
        while start < n:
            r = n - start
            fits = [(self.size - used, k) for k, (used, _) in enumerate(self.open) if self.size - used >= r]
            if fits:
                k = min(fits)[1]
            elif len(self.open) < self.slots:
                self.open.append((0, self._new()))
                k = len(self.open) - 1
            else:
                k = max(range(len(self.open)), key=lambda i: (self.open[i][0], -i))
                used, s = self.open.pop(k)
                if self.size - used >= self.min_cut:
                    out.append((start, self.size - used, s, used))
                    start += self.size - used
                self.closed.add(s)
                continue
            used, s = self.open[k]
            out.append((start, r, s, used))
            start = n
            if used + r == self.size:
                self.open.pop(k)
                self.closed.add(s)
            else:
                self.open[k] = (used + r, s)
        return out


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, seq long, offset long"


def _pack(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, part = encoder(path), Packer(size), TaskContext.get().partitionId()
        end = np.array([EOD], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.ids(text.as_py() or "") + end
                n = len(ids) // 4
                for start, length, seq, offset in packer.add(n):
                    rows.append((doc, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n, part, seq, offset))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=[x.split()[0] for x in _PIECES.split(", ")])
        # a mark for each window that is still open
        left = [s for _, s in packer.open]
        none = pa.nulls(len(left), pa.int64())
        yield pa.record_batch([none, none, none, none, none, pa.array([part] * len(left), pa.int64()), pa.array(left, pa.int64()), none],
                              names=[x.split()[0] for x in _PIECES.split(", ")])
    return run


def _merge(size: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """Best fit, longest first, of the pieces of a group's open windows."""
        pdf = pdf.sort_values(["length", "part", "seq", "offset"], ascending=[False, True, True, True], kind="stable")
        space: list[int] = []
        seqs, offs = [], []
        for n in pdf["length"].tolist():
            fits = [(s, k) for k, s in enumerate(space) if s >= n]
            if fits:
                k = min(fits)[1]
            else:
                space.append(size)
                k = len(space) - 1
            seqs.append(k)
            offs.append(size - space[k])
            space[k] -= n
        pdf = pdf.assign(sequence_id=[((1 << 30) + int(key[0])) << 32 | k for k in seqs], offset=offs)
        return pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset). A document is its ids and then id 1; null and empty texts are that id alone.
    Every row is packed, repeated and null ids too; an empty table gives no rows. A
    sequence never exceeds ``size`` and has no gap. Sequence ids derive from the input's
    partitions, so a task that is run again repeats them."""
    spark = docs.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "packing")
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    src = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    pieces = scratch.save(src.mapInArrow(_pack(tokenizer, size), _PIECES), "pieces")
    marks = pieces.where("length IS NULL").select("part", "seq")
    rows = pieces.where("length IS NOT NULL")
    done = rows.join(marks, ["part", "seq"], "left_anti").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.expr("shiftleft(part, 32) | seq").alias("sequence_id"), "offset")
    # at most MERGE x OPEN windows to a group
    left = rows.join(marks, ["part", "seq"], "left_semi").withColumn("g", F.expr(f"part DIV {MERGE}"))
    merged = left.groupBy("g").applyInPandas(
        _merge(size), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return done.unionByName(merged)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
