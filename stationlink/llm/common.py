"""Shared helpers: input tables, scratch tables, and vectorised word hashing."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlink.session import checkpoint_dir

# words are runs of characters other than these six (space, \t, \n, \v, \f, \r)
WORD_SEP = r"[\x20\x09-\x0D]+"
# rows per Arrow batch: a few MB of usual text, so Python workers stay small
ARROW_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def python_workers(spark: SparkSession) -> None:
    """Make ready for Python tasks: send this package to the executors (once a context)
    and lower the Arrow batch length to ``ARROW_ROWS`` (a lower setting stays)."""
    sc = spark.sparkContext
    if not getattr(sc, "_stationlink_sent", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="stationlink-"), "stationlink.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
        sc._stationlink_sent = True
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


class Scratch:
    """Intermediate tables of one job, as Parquet below the shared checkpoint folder.

    They cut lineage: a lost executor costs the tasks after the last table only.
    ``drop`` deletes a table that nothing reads any more; what the returned DataFrame
    still reads stays until the Python process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(self._delete, self.root)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        # the shuffle files of the write go with its end, not when the driver's heap is collected
        clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(clean)
        self.spark.conf.set(clean, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.set(clean, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def free(self) -> None:
        """Have Spark delete shuffle files of plans that nothing refers to any more: it does so
        when the driver's heap is collected, which may not happen during a long job."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            path = getattr(t, "_scratch_path", None)
            if path:
                self._delete(path)

    def _delete(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may have ended; the folder is scratch
            pass


def crc_mod(col: str, m: int):
    """crc32 of the id written as text, modulo m."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


# ---- word hashing over Arrow text columns -------------------------------------------

_rng = np.random.default_rng(20240229)
_VAL = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SEP_SPACE = np.zeros(256, bool)
SEP_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
VAL_LOWER = _VAL[_LOWER].copy()
VAL_LOWER[SEP_SPACE] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_pow = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        for i, m in enumerate((_MUL, _MUL_INV)):
            p = np.full(max(n, 1 << 16), m, np.uint64)
            p[0] = 1
            _pow[i] = np.cumprod(p, dtype=np.uint64)
    return _pow[0], _pow[1]


def text_slices(col: pa.Array, max_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole rows of about ``max_bytes``: (first row, end
    row, UTF-8 bytes, offsets of the rows in them). Null counts as empty."""
    arr = pc.fill_null(col, "").cast(pa.large_string())
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if len(bufs) > 2 and bufs[2] is not None else np.zeros(0, np.uint8)
    i, n = 0, len(arr)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def hash_words(buf: np.ndarray, off: np.ndarray, sep: np.ndarray = SEP_SPACE,
               val: np.ndarray = VAL_LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows of a slice: (start byte of each, 64-bit hash of each, first word
    of each row + end). A hash is a polynomial over random byte values, then mixed;
    ``val`` must be 0 at separators. A-Z hash like a-z. Two different words share a hash
    with probability about 2^-60."""
    n = len(buf)
    word = ~sep[buf]
    start = word.copy()
    start[1:] &= ~word[:-1]
    rows = off[:-1][off[:-1] < n]
    start[rows] = word[rows]
    starts = np.flatnonzero(start)
    if len(starts) == 0:
        return starts, np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    up, down = _powers(n)
    h = mix(np.add.reduceat(val[buf] * up[:n], starts) * down[starts])
    return starts, h, np.searchsorted(starts, off)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive values (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out = out * _MUL + h[i:i + n]
    return mix(out)
