"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

1. Entries become integers. Tasks sum vectors and products exactly; n * sum(x x') - S S'
   is the integer scatter A = n^2 V of the covariance V (divisor n).
2. One task for each prime reduces A to Hessenberg form modulo the prime and reads off the
   characteristic polynomial; Chinese remaindering joins the residues. Maclaurin's bound
   on elementary symmetric sums of the eigenvalues says how many primes are enough.
3. All roots are real, so the sign changes of p(x + a) count the roots above a exactly,
   with multiplicity (Descartes). One task for each component halves down to its root,
   to ``ROOT_BITS`` bits, and finds the null space of A - root by inverse iteration in
   ``FIXED`` bits fixed point. Equal roots share one orthonormal basis.
4. Rows are centred, projected and divided by the root of the eigenvalue.

What passes the driver grows with the dimension only (its square), never with the rows.

Rows whose vector is null, empty, holds a null or a non-finite entry, or has another
length than most of those left (a tie: the shorter) are dropped; the rest are kept, equal
ones and null or repeated ids included. Entries beyond +-2^42 count as that bound.
Components of eigenvalue 0 are left out, so there may be fewer than asked for, and none
for a single vector. A deviation that does not fit a long is null. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, python_workers, read

SCALE = 1024          # an entry c becomes floor(SCALE * c) + SHIFT
SHIFT = 100_000       # no covariance depends on it: sums are taken without
LIMIT = 2.0 ** 52     # of scaled entries
COMPONENTS = 8
ROOT_BITS = 100       # of a root, relative
SAME_BITS = 80        # roots that agree in so many bits share a basis
FIXED = 400           # bits after the point in inverse iteration
LIMB = 60             # sums travel as two decimals: multiples of 2^LIMB and the rest


# ---- integer vectors ----------------------------------------------------------------

def _scaled(col: pa.Array, d: int) -> np.ndarray:
    """Rows of scaled entries without the shift, int64."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64).reshape(-1, d)


def _sums(d: int):
    """Exact sums of one partition: (i, j, hi, lo); i = -1 holds the vector sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, rows = np.zeros(d, object), np.zeros((d, d), object), 0
        for batch in batches:
            y = _scaled(batch.column(0), d)
            rows += len(y)
            top = int(np.abs(y).max(initial=0))
            if top * top * len(y) < 1 << 53:        # float products and their sums are exact
                f = y.astype(np.float64)
                second += (f.T @ f).astype(np.int64)
                first += y.sum(axis=0)
            else:
                o = y.astype(object)
                second += o.T.dot(o)
                first += o.sum(axis=0)
        if rows:
            at = [(-1, j, first[j]) for j in range(d)] + [(i, j, second[i, j]) for i in range(d) for j in range(i, d)]
            dec = pa.decimal128(38, 0)
            yield pa.record_batch([
                pa.array([i for i, _, _ in at], pa.int32()), pa.array([j for _, j, _ in at], pa.int32()),
                pa.array([Decimal(int(v) >> LIMB) for _, _, v in at], dec),
                pa.array([Decimal(int(v) & ((1 << LIMB) - 1)) for _, _, v in at], dec)], names=["i", "j", "hi", "lo"])
    return run


# ---- characteristic polynomial ------------------------------------------------------

def primes_below(top: int, k: int) -> list[int]:
    """The k largest primes below ``top`` (at most 2^31), by a sieve of segments."""
    small = np.ones(isqrt(top) + 1, bool)
    small[:2] = False
    for q in range(2, isqrt(len(small)) + 1):
        if small[q]:
            small[q * q::q] = False
    out: list[int] = []
    while len(out) < k and top > len(small):
        low = max(top - 100_000, len(small))
        seg = np.ones(top - low, bool)
        for q in np.flatnonzero(small).tolist():
            seg[-low % q::q] = False
        out += (low + np.flatnonzero(seg)[::-1]).tolist()
        top = low
    return out[:k]


def charpoly_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of det(x - a) modulo the prime p < 2^31."""
    a, d = a.copy(), len(a)
    for k in range(1, d - 1):
        below = np.flatnonzero(a[k:, k - 1])
        if not len(below):
            continue
        i = k + int(below[0])
        a[[i, k]] = a[[k, i]]
        a[:, [i, k]] = a[:, [k, i]]
        f = a[k + 1:, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1:] = (a[k + 1:] - f[:, None] * a[k] % p) % p
        a[:, k] = (a[:, k] + (a[:, k + 1:] * f % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)      # of the leading blocks
    polys[0, 0] = 1
    for k in range(1, d + 1):
        prev = polys[k - 1]
        new = -int(a[k - 1, k - 1]) * prev % p
        new[1:] += prev[:-1]
        step, c = 1, np.zeros(k - 1, np.int64)
        for i in range(k - 1, 0, -1):
            step = step * int(a[i, i - 1]) % p
            c[i - 1] = step * int(a[i - 1, k - 1]) % p
        polys[k] = (new - (c[:, None] * polys[:k - 1] % p).sum(axis=0)) % p
    return polys[d]


def _residues(matrix: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.array(matrix, object)
        for batch in batches:
            ps = batch.column(0).to_pylist()
            yield pa.record_batch([pa.array(ps, pa.int64()), pa.array(
                [charpoly_mod((a % p).astype(np.int64), p).tolist() for p in ps], pa.list_(pa.int64()))], names=["p", "c"])
    return run


def charpoly(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of det(x - A) of a positive semidefinite integer matrix."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    ps = primes_below(1 << 31, 2 + (2 * bound).bit_length() // 30)
    table = spark.createDataFrame([(p,) for p in ps], "p long").mapInArrow(_residues(matrix), "p long, c array<long>").collect()
    m, out = 1, [0] * (d + 1)
    for r in table:
        inv = pow(m, -1, r.p)
        out = [x + m * ((c - x) * inv % r.p) for x, c in zip(out, r.c, strict=True)]
        m *= r.p
    return [x - m if 2 * x > m else x for x in out]


# ---- roots and components -----------------------------------------------------------

def roots_above(poly: list[int], a: int, s: int) -> int:
    """How many roots (all real) of ``poly`` are greater than a / 2^s."""
    d = len(poly) - 1
    c = [x << (s * (d - i)) for i, x in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def kth_root(poly: list[int], k: int, top: int) -> tuple[int, int, int, int]:
    """The k-th largest root (positive, below ``top``): it lies in (a, a + 1] / 2^s, and it
    is number ``first`` to ``last`` of roots that agree in ``SAME_BITS`` bits: (a, s, first, last)."""
    lo, hi, s = 0, top, 0
    while True:
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if roots_above(poly, mid, s) >= k else (lo, mid)
        if lo.bit_length() > ROOT_BITS:
            break
        more = max(ROOT_BITS + 1 - lo.bit_length(), 1) if lo else 32
        lo, hi, s = lo << more, hi << more, s + more
    tol = lo >> SAME_BITS
    return lo, s, roots_above(poly, hi + tol, s) + 1, roots_above(poly, lo - tol, s)


def _solve(m: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solution in fixed point, by elimination with row pivots; a zero pivot counts as the last bit."""
    m, d = np.concatenate([m, rhs], axis=1), len(m)
    for k in range(d):
        i = k + int(np.argmax(np.abs(m[k:, k])))
        m[[i, k]] = m[[k, i]]
        m[k, k] = m[k, k] or 1
        f = (m[k + 1:, k] << FIXED) // m[k, k]
        m[k + 1:, k:] -= (f[:, None] * m[k, k:]) >> FIXED
    x = m[:, d:]
    for k in reversed(range(d)):
        x[k] = (x[k] << FIXED) // m[k, k]
        x[:k] -= (m[:k, k][:, None] * x[k]) >> FIXED
    return x


def _orthonormal(x: np.ndarray) -> np.ndarray:
    out: list[np.ndarray] = []
    for v in x.T:
        v = (v << FIXED) // max(int(np.abs(v).max()), 1)
        for u in out * 2:                           # twice: what rounding leaves of the first time
            v = v - ((u * (int((u * v).sum()) >> FIXED)) >> FIXED)
        out.append((v << FIXED) // max(isqrt(int((v * v).sum())), 1))
    return np.array(out, object).T


def null_space(matrix: list[list[int]], a: int, s: int, size: int) -> np.ndarray:
    """Orthonormal basis (columns, double) of the eigenvectors of a root near a / 2^s that
    ``size`` eigenvalues share; the largest entry of each is positive."""
    unit = max(sum(matrix[i][i] for i in range(len(matrix))).bit_length(), 1)
    m = np.array([[(x << FIXED) >> unit for x in row] for row in matrix], object)
    at = ((2 * a + 1) << FIXED) >> (s + 1 + unit)
    for i in range(len(m)):
        m[i, i] -= at
    seed, start = 1, np.zeros((len(m), size), object)
    for i in range(len(m)):
        for j in range(size):
            seed = (seed * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            start[i, j] = (seed - (1 << 63)) << (FIXED - 63)
    x = start
    for _ in range(4):
        x = _orthonormal(_solve(m, x))
    out = np.array([[float(Fraction(int(v), 1 << FIXED)) for v in row] for row in x])
    return out * np.where(out[np.argmax(np.abs(out), axis=0), np.arange(size)] < 0, -1.0, 1.0)


def _components(matrix: list[list[int]], poly: list[int], n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trace = sum(matrix[i][i] for i in range(len(matrix)))
        for batch in batches:
            for k in batch.column(0).to_pylist():
                a, s, first, last = kth_root(poly, k, trace + 1)
                v = null_space(matrix, a, s, last - first + 1)[:, k - first]
                root = Fraction(2 * a + 1, 1 << (s + 1))
                yield pa.record_batch([pa.array([k], pa.int64()), pa.array([float(root / n ** 2)]), pa.array([float(root / trace)]),
                                       pa.array([v.tolist()], pa.list_(pa.float64()))], names=["k", "e", "explained", "v"])
    return run


# ---- rows ---------------------------------------------------------------------------

def _project(d: int, n: int, total: list[int], vectors: np.ndarray, roots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _scaled(batch.column(1), d)
            top = int(np.abs(y).max(initial=0)) * n + max(map(abs, total))
            small = top < 1 << 53
            z = y * n - np.array(total) if small else y.astype(object) * n - np.array(total, object)
            if top * top * d < 1 << 63:
                dev = (z * z).sum(axis=1).tolist()
            else:
                dev = [x if x < 1 << 63 else None for x in (z.astype(object) ** 2).sum(axis=1).tolist()]
            centred = z / n if small else np.array([[float(Fraction(v, n)) for v in row] for row in z.tolist()])
            w = centred.astype(np.float64) @ vectors / roots
            yield pa.record_batch([batch.column(0), pa.array(dev, pa.int64()), pa.FixedSizeListArray.from_arrays(
                pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row
    kept and component; see the module for what is dropped."""
    spark = df.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "whitening")
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("x")).where(
        "size(x) > 0 AND NOT exists(x, c -> c IS NULL OR isnan(c) OR abs(c) = double('Infinity'))")
    size = src.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if size is None:
        return empty
    d, n = size.d, size.n
    src = src.where(F.size("x") == d)
    dec = "decimal(38,0)"
    sums = src.select("x").mapInArrow(_sums(d), f"i int, j int, hi {dec}, lo {dec}").groupBy("i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))
    total, second = [0] * d, [[0] * d for _ in range(d)]
    for r in sums.collect():                        # d (d + 3) / 2 rows
        v = (int(r.hi) << LIMB) + int(r.lo)
        if r.i < 0:
            total[r.j] = v
        else:
            second[r.i][r.j] = second[r.j][r.i] = v
    matrix = [[n * second[i][j] - total[i] * total[j] for j in range(d)] for i in range(d)]
    if not any(matrix[i][i] for i in range(d)):
        return empty
    poly = charpoly(spark, matrix)
    rank = d - next(i for i, c in enumerate(poly) if c)
    wanted = spark.range(1, 1 + min(components, rank), 1, min(components, rank))
    found = sorted(wanted.mapInArrow(_components(matrix, poly, n), "k long, e double, explained double, v array<double>").collect())
    vectors, roots = np.array([r.v for r in found]).T, np.sqrt([r.e for r in found])
    rows = scratch.save(src.mapInArrow(_project(d, n, total, vectors, roots), f"vec_id {kind}, deviation long, w array<double>"), "white")
    k = len(found)
    pairs = [F.abs(F.covar_pop(F.col("w")[i], F.col("w")[j]) - (1.0 if i == j else 0.0)) for i in range(k) for j in range(i + 1)]
    error = rows.agg(F.array_max(F.array(*pairs)).alias("x")).first().x
    explained = F.array(*[F.lit(r.explained) for r in found])
    out = rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
