"""Feature preparation: target selection, sequential IQR filter, replicate by count,
exact reproducible undersampling and splitting, standardization."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import binarize, to_number
from ..schemas import SEED, TARGET_MIN_TOTAL
from ..session import checkpoint_dir

# Ranked selection: hex digits of the md5 per radix level (16 bits), the most rows one
# window may rank in an edge bucket before the bucket is refined by the next digits, and
# the most rows of a per-class table that is broadcast.
RANK_LEVEL_HEX = 4
EDGE_RANK_MAX = 2_000_000
BROADCAST_ROWS_MAX = 100_000


def select_targets(panel: DataFrame, targets: list, threshold: float = TARGET_MIN_TOTAL) -> DataFrame:
    """``target, total`` for the targets whose column sum is above ``threshold`` (a null
    sum is dropped). One aggregate over all targets, then an unpivot: one job."""
    sums = panel.agg(*[F.sum(F.col(f"`{t}`")).cast("decimal(38,6)").alias(t) for t in targets])
    long = sums.unpivot([], list(targets), "target", "total")
    # compared before the cast: a sum of 300.6 is above 300
    return long.where(F.col("total") > F.lit(threshold)).withColumn("total", F.col("total").cast("bigint"))


# Exact quantiles: up to this many values Spark's ``percentile`` aggregate is used (its
# buffer holds one entry per distinct value). Above it, a sketch brackets each rank to
# ``4 / SKETCH_ACCURACY`` of the rows and a second scan gathers what lies inside; at most
# ``REFINE_COLLECT_MAX`` distinct values are read, more are first narrowed by ``CUTS`` values.
EXACT_QUANTILE_MAX_VALUES = 1_000_000
SKETCH_ACCURACY = 20_000
REFINE_COLLECT_MAX = 10_000
CUTS = 1_000


def _interpolate(vals: dict, n: int, p: float) -> float:
    # linear interpolation between order statistics, same arithmetic as Spark's percentile
    pos = (n - 1) * p
    lo, hi = math.floor(pos), math.ceil(pos)
    if lo == hi or vals[lo] == vals[hi]:
        return float(vals[lo])
    return (hi - pos) * float(vals[lo]) + (pos - lo) * float(vals[hi])


def _regions(x: Column, brackets: list) -> Column:
    """Number of the region of a value: 2 i + 1 in the i-th bracket, 2 i below it, else after all."""
    out = F.lit(2 * len(brackets))
    for i, (a, b) in reversed(list(enumerate(brackets))):
        out = F.when(x < F.lit(a), 2 * i).when(x <= F.lit(b), 2 * i + 1).otherwise(out)
    return out


def _merged(brackets: list) -> list:
    out: list = []
    for a, b in sorted(brackets):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _value_at(counts: DataFrame, rank: int, collect_max: int) -> float:
    """ACTION. The value at a 0-based rank of (``v``, ``c``): how often each value is there."""
    while True:
        n = counts.count()
        if n <= collect_max:
            for v, c in counts.orderBy("v").collect():
                if rank < c:
                    return v
                rank -= c
            raise ValueError("rank beyond the values")
        # cuts of about equal numbers of distinct values; the one with the rank goes on
        cuts = sorted(set(counts.agg(F.percentile_approx("v", [k / CUTS for k in range(1, CUTS)], 10 * CUTS)).first()[0]))
        part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("v")))
        sums = dict(counts.groupBy(part.alias("p")).agg(F.sum("c")).collect())
        for p in sorted(sums):
            if rank < sums[p]:
                break
            rank -= sums[p]
        if p > 0:
            counts = counts.where(F.col("v") >= F.lit(cuts[p - 1]))
        if p < len(cuts):
            counts = counts.where(F.col("v") < F.lit(cuts[p]))


def _order_statistics(df: DataFrame, col: str, ranks: list, lo: float, hi: float, n: int | None = None, brackets: list | None = None,
                      collect_max: int | None = None) -> dict:
    """ACTION. The values at 0-based ``ranks`` of the non-null values of ``col``, whose
    least and greatest value are ``lo`` and ``hi``. One scan brackets all ranks by a
    quantile sketch (left out if ``n`` and the ``brackets`` are given). One more scan counts
    the rows outside the brackets and the occurrences of each value inside, in one
    aggregate; the ranks are found in these counts. Only if a bracket should miss its rank
    is the region that holds it scanned as well."""
    x = F.col(col)
    if brackets is None:
        n = n if n is not None else df.agg(F.count(x)).first()[0]
        brackets = _sketch(df, x, [(r + 0.5) / n for r in ranks])[1]
    brackets = _merged(brackets)
    checkpoint_dir(df.sparkSession)
    out: dict = {}
    while len(out) < len(ranks):
        region = _regions(x, brackets)
        counts = (df.where(x.isNotNull()).groupBy(region.alias("region"), F.when(region % 2 == 1, x).alias("v"))
                  .agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True))
        sums = dict(counts.groupBy("region").agg(F.sum("c")).collect())
        ends = [lo, *[e for b in brackets for e in b], hi]
        missed = []
        for r in ranks:
            if r in out:
                continue
            below = 0
            for region_no in sorted(sums):
                if r < below + sums[region_no]:
                    break
                below += sums[region_no]
            if region_no % 2:
                a, b = brackets[region_no // 2]
                out[r] = a if a == b else _value_at(counts.where(F.col("region") == region_no).select("v", "c"), r - below, collect_max or REFINE_COLLECT_MAX)
            else:
                missed.append((ends[region_no], ends[region_no + 1]))
        brackets = _merged(missed) if missed else brackets
    return out


def _sketch(df: DataFrame, x: Column, shares: list) -> tuple:
    """ACTION. (count, brackets, least, greatest) by one aggregate: a bracket is a value below and one above a share."""
    gap = 2 / SKETCH_ACCURACY
    at = [min(max(s + d, 0.0), 1.0) for s in shares for d in (-gap, gap)]
    r = df.agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.percentile_approx(x, at, SKETCH_ACCURACY).alias("q")).first()
    if not r.n:
        return 0, [], None, None
    ends = [r.lo if s <= 0 else r.hi if s >= 1 else v for s, v in zip(at, r.q, strict=True)]
    return r.n, list(zip(ends[::2], ends[1::2], strict=True)), r.lo, r.hi


def exact_quantiles(df: DataFrame, col: str, probs: list, max_values: int = EXACT_QUANTILE_MAX_VALUES,
                    rows_at_most: int | None = None) -> list:
    """ACTION. Exact quantiles of the non-null values of ``col`` with linear interpolation
    (the pandas default), with bounded memory in every task and on the driver, in two
    scans. ``rows_at_most``: a known bound on the row count; when it is within
    ``max_values`` one scan does."""
    x = F.col(col)
    if rows_at_most is not None and rows_at_most <= max_values:
        v = df.agg(F.percentile(x, F.array(*[F.lit(float(p)) for p in probs]))).first()[0]
        return [None] * len(probs) if v is None else [float(q) for q in v]
    n, brackets, lo, hi = _sketch(df, x, [float(p) for p in probs])
    if n == 0:
        return [None] * len(probs)
    if n <= max_values:
        return [float(v) for v in df.agg(F.percentile(x, F.array(*[F.lit(float(p)) for p in probs]))).first()[0]]
    ranks = sorted({f((n - 1) * p) for p in probs for f in (math.floor, math.ceil)})
    vals = _order_statistics(df, col, ranks, lo, hi, n, brackets)
    return [_interpolate(vals, n, p) for p in probs]


def quantile_bounds(df: DataFrame, col: str, k: float = 1.5, accuracy: int | None = None,
                    rows_at_most: int | None = None, max_values: int = EXACT_QUANTILE_MAX_VALUES) -> tuple:
    """ACTION (small aggregates, one row back each). Lower and upper IQR bounds of ``col``.

    Exact by default (``exact_quantiles``); ``accuracy`` switches to the
    ``percentile_approx`` sketch, one pass with a fixed-size buffer."""
    if accuracy is None:
        q1, q3 = exact_quantiles(df, col, [0.25, 0.75], max_values, rows_at_most)
    else:
        r = df.agg(F.percentile_approx(F.col(col), F.array(F.lit(0.25), F.lit(0.75)), accuracy)).first()[0]
        q1, q3 = (None, None) if r is None else (r[0], r[1])
    if q1 is None:
        return None, None
    q1, q3 = float(q1), float(q3)
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def iqr_filter(df: DataFrame, features: list, k: float = 1.5, accuracy: int | None = None,
               max_values: int = EXACT_QUANTILE_MAX_VALUES) -> DataFrame:
    """Coerce the features to double, drop rows with a null in any of them, then for
    each feature in order keep ``lo <= x <= hi`` where the bounds are computed on the
    rows the previous features left.

    One count, then one small aggregate job per feature (the bounds depend on the
    previous filter);
    the bounds come back as literals, so the returned plan is a plain filtered scan
    whose predicates Catalyst can push down."""
    cur = df.select(*[to_number(F.col(c)).alias(c) if c in features else F.col(c) for c in df.columns])
    cur = cur.na.drop(subset=list(features))
    # the rows before the first filter bound the count of every later step: one count
    # decides the exact path for all features
    bound = cur.count() if accuracy is None else None
    for f in features:
        lo, hi = quantile_bounds(cur, f, k, accuracy, bound, max_values)
        if lo is None:
            return cur.limit(0)
        cur = cur.where((F.col(f) >= F.lit(lo)) & (F.col(f) <= F.lit(hi)))
    return cur


# Copies one task writes for one input row at most: a row with a larger count (a third
# of the output may come from one row) is first cut into chunks of this many copies,
# and only those chunk rows are spread over the cluster before they are expanded.
REPLICATE_CHUNK = 1_000_000


def replicate(df: DataFrame, count_col: str, copy_col: str = "copy", chunk: int = REPLICATE_CHUNK) -> DataFrame:
    """Repeat each row ``count`` times (0, negative and null count once) and number the
    copies 1..n so that every output row keeps a unique identity.

    Rows with at most ``chunk`` copies are expanded where they are read. Rows with more
    (few by nature: their copies dominate the output) become one row per chunk, which a
    round-robin shuffle of those rows only spreads over the tasks; each chunk is then
    expanded on its own. The filter on the count reaches the scan."""
    c = F.col(count_col)
    n = F.greatest(F.coalesce(c, F.lit(0)), F.lit(1))
    light = df.where(c.isNull() | (c <= F.lit(chunk))).withColumn(copy_col, F.explode(F.sequence(F.lit(1), n)))
    heavy = (df.where(c > F.lit(chunk))
             .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(chunk)))))
             .repartition(df.sparkSession.sparkContext.defaultParallelism))
    first = F.col("_chunk") * F.lit(chunk) + 1
    last = F.least(first + F.lit(chunk - 1), n.cast("long"))
    copy_type = light.schema[copy_col].dataType
    heavy = heavy.withColumn(copy_col, F.explode(F.sequence(first.cast(copy_type), last.cast(copy_type))))
    heavy = heavy.drop("_chunk")
    return light.unionByName(heavy)


def prepare_target(df: DataFrame, features: list, target: str, id_cols: tuple = (),
                   copy_col: str = "copy") -> DataFrame:
    """Per-target training rows: fill the target with 0, cast to int, replicate by the
    count (``copy_col`` numbers the copies, so ``id_cols + copy_col`` identify a row),
    binarize, drop rows with any null."""
    y = F.coalesce(F.col(f"`{target}`"), F.lit(0)).cast("int")
    base = df.select(*[F.col(f"`{c}`") for c in list(id_cols) + list(features)], y.alias(target))
    rep = replicate(base, target, copy_col)
    return rep.withColumn(target, binarize(F.col(target))).na.drop()


def hash_key(id_cols: list, seed: int = SEED) -> Column:
    """md5 hex of ``seed|id1|id2...``: reproducible, independent of partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_cols]))


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only for a side whose row count was checked to be small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS_MAX else df


def _edge_buckets(counts: DataFrame, state: DataFrame, class_col: str) -> DataFrame:
    """Per class: the first bucket (``_p`` in hash order under the parent prefix ``_E``)
    where the running count passes ``_need``. Returns ``class, _E`` (extended by that
    bucket), ``_need`` (rows still wanted inside it) and ``_en`` (its rows). A class
    whose rows all fit comes back with a null ``_E``: every row is in."""
    w = Window.partitionBy(class_col).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = state.select(F.col(class_col).alias("_k"), F.col("_need"))
    c = counts.withColumn("_cum", F.sum("_n").over(w))
    c = c.join(s, c[class_col].eqNullSafe(s["_k"]), "left").drop("_k")
    need = F.coalesce(F.col("_need"), F.lit(0))
    passed = (c.where(F.col("_cum") > need)
              .groupBy(class_col)
              .agg(F.min_by(F.struct(F.concat("_E", "_p").alias("_E"), (need - (F.col("_cum") - F.col("_n")))
                                     .alias("_need"), F.col("_n").alias("_en")), F.col("_p")).alias("_e"))
              .select(class_col, "_e.*"))
    everything = (counts.select(class_col).distinct()
                  .join(passed, counts[class_col].eqNullSafe(passed[class_col]), "left_anti")
                  .select(class_col, F.lit(None).cast("string").alias("_E"), F.lit(None).cast("long").alias("_need"),
                          F.lit(None).cast("long").alias("_en")))
    return passed.unionByName(everything)


def mark_lowest_hash(df: DataFrame, class_col: str, id_cols: list, quota_of,
                     out_col: str = "selected", seed: int = SEED, level_hex: int = RANK_LEVEL_HEX,
                     edge_max: int = EDGE_RANK_MAX) -> DataFrame:
    """Add ``out_col``: true for the ``quota`` rows of each class with the smallest
    ``hash_key`` (ties by id), exactly what ``ROW_NUMBER() OVER (PARTITION BY class
    ORDER BY md5) <= quota`` gives, without sorting a whole class in one task.

    A radix selection on the hex md5: rows are counted per (class, first ``level_hex``
    digits); a running sum over these buckets finds, per class, the edge bucket where the
    quota runs out. A class whose edge bucket holds more than ``edge_max`` rows is refined
    by the next digits, counting only the rows of that bucket, until it is small. Rows that
    repeat their ids are equal in hash: of those at a threshold as many as fit are in. The rows of the edge buckets alone
    are ranked by a window, which gives per class the last (hash, ids) that is in. The
    result is then one map-side pass: a row is in when its prefix is before its class's
    edge prefix, or equal and its (hash, ids) not after that threshold (a comparison with
    one row per class, broadcast when the class count is checked small).
    ``quota_of`` maps the per-class counts (``class_col, n``) to ``class_col, quota``.
    Actions: one small aggregate over the first-level count table (cached while it is
    used), a checkpoint per refinement level (at large scale only), and the checkpoint of
    the per-class table with the thresholds, so the returned plan carries no ranking."""
    d = df.withColumn("_h", hash_key(id_cols, seed))
    counts = (d.groupBy(class_col, F.substring("_h", 1, level_hex).alias("_p"))
              .agg(F.count(F.lit(1)).alias("_n")).withColumn("_E", F.lit("")).cache())
    try:
        quota = quota_of(counts.groupBy(class_col).agg(F.sum("_n").alias("n")))
        checkpoint_dir(df.sparkSession)
        # one row per class, from the cached count table
        edges = _edge_buckets(counts, quota.select(class_col, F.col("quota").alias("_need")), class_col)
        st = edges.agg(F.count(F.lit(1)).alias("k"), F.max("_en").alias("big")).first()
        depth = level_hex
        while st["big"] is not None and st["big"] > edge_max and depth + level_hex <= 32:
            # the classes whose edge bucket is too big for one ranking task: count the rows of
            # that bucket only, by the next digits of the hash
            big = edges.where(F.col("_en") > edge_max).select(F.col(class_col).alias("_k"), "_E", "_need")
            nb = big.count()
            sub = d.join(_maybe_broadcast(big, nb), d[class_col].eqNullSafe(F.col("_k")))
            sub = sub.where(F.substring("_h", 1, depth) == F.col("_E"))
            c2 = (sub.groupBy(class_col, "_E", F.substring("_h", depth + 1, level_hex).alias("_p"))
                  .agg(F.count(F.lit(1)).alias("_n")))
            refined = _edge_buckets(c2, big.withColumnRenamed("_k", class_col), class_col)
            small = edges.where(F.col("_en").isNull() | (F.col("_en") <= edge_max))
            edges = small.unionByName(refined).checkpoint(eager=True)
            st = edges.agg(F.count(F.lit(1)).alias("k"), F.max("_en").alias("big")).first()
            depth += level_hex
        # per class the need-th smallest (hash, ids) of its edge bucket: the bucket's rows up
        # to it are in. Only edge-bucket rows are shuffled and ranked (one window per class
        # over at most edge_max rows), once, into the per-class table
        e = edges.select(F.col(class_col).alias("_k"), "_E", "_need")
        key = F.struct(F.col("_h"), *[F.col(c) for c in id_cols])
        in_edge = (d.join(_maybe_broadcast(e, st["k"]), d[class_col].eqNullSafe(F.col("_k")))
                   .where((F.col("_need") > 0) & (F.substring(F.col("_h"), F.lit(1), F.length("_E")) == F.col("_E"))))
        rw = Window.partitionBy("_k").orderBy("_h", *id_cols)
        same = Window.partitionBy("_k", "_h", *id_cols)
        # of rows equal to the threshold in hash and ids, _eq of _eqn are in
        th = (in_edge.select(F.col("_k").alias("_k2"), key.alias("_th"), F.row_number().over(rw).alias("_rn"), "_need",
                             (F.col("_need") - F.rank().over(rw) + 1).alias("_eq"), F.count(F.lit(1)).over(same).alias("_eqn"))
              .where(F.col("_rn") == F.col("_need")).select("_k2", "_th", "_eq", "_eqn"))
        # written to the checkpoint folder: the returned plan reads it back instead of
        # carrying the counting and ranking plans along
        table = e.join(th, e["_k"].eqNullSafe(th["_k2"]), "left").drop("_k2").checkpoint(eager=True)
        split = table.where("_eqn > _eq").count() > 0
    finally:
        counts.unpersist()
    # one map-side pass: a comparison with the class's row (no edge: the quota covers
    # the whole class; no threshold: nothing of the edge bucket is in)
    d = d.join(_maybe_broadcast(table, st["k"]), d[class_col].eqNullSafe(F.col("_k")), "left").drop("_k")
    pre = F.substring(F.col("_h"), F.lit(1), F.length("_E"))
    sel = (F.col("_E").isNull() | (pre < F.col("_E"))
           | ((pre == F.col("_E")) & F.coalesce(key <= F.col("_th"), F.lit(False))))
    if not split:
        return d.withColumn(out_col, sel).drop("_h", "_E", "_need", "_th", "_eq", "_eqn")
    # repeated ids at a threshold: these rows alone are numbered
    tie = F.coalesce((pre == F.col("_E")) & (key == F.col("_th")), F.lit(False))
    number = F.row_number().over(Window.partitionBy(class_col).orderBy(F.xxhash64(*df.columns)))
    ties = d.where(tie).withColumn("_i", number).withColumn(out_col, F.col("_i") <= F.col("_eq")).drop("_i")
    return d.where(~tie).withColumn(out_col, sel).unionByName(ties).drop("_h", "_E", "_need", "_th", "_eq", "_eqn")


def undersample(df: DataFrame, class_col: str, id_cols: list, classes: tuple = (0, 1),
                seed: int = SEED) -> DataFrame:
    """Exact 1:1 (n:n for more classes) balance: every class keeps its ``m`` rows with the
    smallest hash, ``m`` = the smallest class count. Empty when a class is missing.
    Reproducible: the same rows on a rerun and after any repartition."""
    df = df.where(F.col(class_col).isin(*classes))

    def quota_of(cc):
        # cc has one row per class present (a handful): a window over all of it is tiny
        everything = Window.partitionBy()
        return cc.select(class_col,
                         F.when(F.count(F.lit(1)).over(everything) == len(classes), F.min("n").over(everything))
                          .otherwise(F.lit(0)).alias("quota"))

    return mark_lowest_hash(df, class_col, id_cols, quota_of, "_keep", seed).where("_keep").drop("_keep")


def split_train_test(df: DataFrame, class_col: str, id_cols: list, test_fraction: float = 0.2,
                     seed: int = SEED, out_col: str = "split") -> DataFrame:
    """Stratified split: within each class the ``n - ceil(test_fraction*n)`` rows with the
    smallest hash are ``train``, the rest ``test``."""
    def quota_of(cc):
        return cc.select(class_col, (F.col("n") - F.ceil(F.col("n") * F.lit(test_fraction))).alias("quota"))

    m = mark_lowest_hash(df, class_col, id_cols, quota_of, "_train", seed)
    return m.withColumn(out_col, F.when(F.col("_train"), "train").otherwise("test")).drop("_train")


def standardize(df: DataFrame, features: list, fit_on: Column | None = None, digits: int | None = None,
                suffix: str = "_z") -> DataFrame:
    """ACTION (one aggregate, one row back). Add ``<f>_z = (f - mean) / stddev_samp`` with
    mean and deviation fitted on the rows where ``fit_on`` holds (all rows when None).
    The fitted values come back as literals: the transform is a plain projection."""
    fit = df.where(fit_on) if fit_on is not None else df
    st = fit.agg(*[F.avg(f).alias(f"m_{f}") for f in features],
                 *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    out = df
    for f in features:
        m, sd = st[f"m_{f}"], st[f"s_{f}"]
        z = (F.col(f) - F.lit(m).cast("double")) / F.lit(sd).cast("double")
        out = out.withColumn(f + suffix, F.round(z, digits) if digits is not None else z)
    return out
