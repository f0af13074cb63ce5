"""Connected components, and linking the members of candidate buckets without pairing
whole groups."""

from __future__ import annotations

import itertools
import logging
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

log = logging.getLogger(__name__)


TESTS_A_ROW = 16  # of sketches, that the last step of link_buckets may make on average
EDGES_A_TASK = 500_000  # edges (16 bytes each) that one task contracts in memory


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: its components as stars (a, smallest)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in parent]
    pairs = [(x, r) for x, r in pairs if x != r]
    yield pa.record_batch([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())],
                          names=["a", "b"])


def components(edges: DataFrame, scratch: Scratch, python: bool = True) -> DataFrame:
    """(id, comp) for every id of the edges (a, b): comp is the smallest id reachable.

    With ``python``, each partition of ``EDGES_A_TASK`` edges is first contracted to stars
    by itself; one partition of stars is already the answer. Otherwise alternating
    large-star / small-star rounds follow, each an aggregate and an equi-join on the edge
    table, written out per round. A hub is one aggregate row (map-side min) and a skewed
    join key that AQE splits; nothing is gathered per component.
    """
    e = scratch.save(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    parts = 1 + e.count() // EDGES_A_TASK
    if python:
        stars = scratch.save(e.coalesce(parts).mapInArrow(_contract, "a long, b long"), "stars")
        scratch.drop(e)
        e = stars
    state = None
    while not (python and parts == 1):
        # few edges stay in one partition: then no step of the round shuffles
        few = e.coalesce(1) if parts == 1 else e
        both = few.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.*")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        new = scratch.save(small, "stars")
        scratch.drop(e)
        e = new
        now = (e.coalesce(1) if parts == 1 else e).agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())


def link_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame], scratch: Scratch,
                 python: bool = True, least_gain: float = 0.3,
                 may: Callable[[str, str], str] | None = None, rank: str | None = None,
                 sketches: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Link all pairs of ids that share a bucket and pass ``verify``.

    ``members`` (key, id), distinct and only keys of two or more ids; ``verify`` maps
    candidate pairs (a, b) to those that are linked. Returns (id, comp) of the linked ids,
    and the links (None if there was no candidate). ``python=False`` keeps to DataFrame
    operations. With ``may``, members also have a column ``sketch``, and ``may(x, y)`` is SQL
    of a condition that the sketches of every linked pair meet: the joins that make pairs
    test it, so that pairs that fail it are never written or compared. With ``sketches``
    (id, sketch), members go through the rounds without them, and they are joined where pairs
    are made. ``rank`` names a column of members: pivots are rows of the smallest, those
    without a link first.

    A bucket of n near copies is not paired n x n. In each round every bucket's pivot is
    checked against its other members, the links found so far merge components, the pivot
    leaves (all its pairs are decided), and members that share a component need no check.
    When few open pairs are left, or a round closed less than ``least_gain`` of them, all
    open pairs across components are checked. So no pair of different components goes
    unchecked: the rounds change the work, not the result.
    """
    spark = scratch.spark
    rows = members
    extra = (["sketch"] if may and sketches is None else []) + ([rank] if rank else [])
    test = (lambda x, y: F.expr(may(x, y))) if may else (lambda x, y: F.lit(True))
    links: DataFrame | None = None
    comp: DataFrame | None = None
    old: list[DataFrame] = []
    open_before = float("inf")
    for r in itertools.count():
        if comp is not None:
            rows = rows.join(comp, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"), F.col("comp").isNotNull().alias("linked"), *extra)
        else:
            rows = rows.withColumns({"comp": F.col("id"), "linked": F.lit(False)})
        rows = rows_table = scratch.save(rows, "rows")
        sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
        # the pivot is drawn by a hash of the id, the same order in all buckets, so that
        # buckets of one group share it and its pairs coincide
        by = ["linked", rank] if rank else []
        keys = scratch.save(
            sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.expr("CAST(n AS DOUBLE) * n")).alias("sq"),
                                     F.count("*").alias("comps")).where("comps > 1")
            .join(rows.groupBy("key").agg(F.min_by(F.struct("id", "comp", *extra), F.struct(*by, F.xxhash64("id", F.lit(r)))).alias("p")), "key"),
            "keys")
        tot = keys.agg(F.sum("n"), F.sum(F.expr("(CAST(n AS DOUBLE) * n - sq) / 2"))).first()
        if not tot[0]:
            break
        log.info("round %d: %d bucket rows, %.0f open pairs", r, tot[0], tot[1])
        few = TESTS_A_ROW if sketches is not None and r else 2
        if tot[1] <= few * tot[0] or tot[1] > (1 - least_gain) * open_before:
            open_rows = rows.join(keys.select("key"), "key", "left_semi")
            if sketches is not None:  # each of them is read once for all pairs
                open_rows = scratch.save(open_rows.select("key", "id", "comp").join(sketches, "id"), "open")
                extra = ["sketch"]
            x = open_rows.selectExpr("key", "id AS a", "comp AS ca", *(f"{c} AS a_{c}" for c in extra))
            y = open_rows.selectExpr("key", "id AS b", "comp AS cb", *(f"{c} AS b_{c}" for c in extra))
            pairs = x.join(y, "key").where("ca <> cb AND a < b").where(test("a_sketch", "b_sketch")).select("a", "b").distinct()
            last = True
        else:
            pairs = rows.join(keys.select("key", "p"), "key").where("id <> p.id AND comp <> p.comp")
            if sketches is None:
                pairs = pairs.where(test("sketch", "p.sketch"))
            pairs = pairs.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct()
            if sketches is not None:
                pairs = pairs.join(sketches.selectExpr("id AS a", "sketch AS sa"), "a").join(
                    sketches.selectExpr("id AS b", "sketch AS sb"), "b").where(test("sa", "sb")).select("a", "b")
            last = False
        found = scratch.save(verify(pairs), "links")
        links = found if links is None else scratch.save(links.unionByName(found), "all-links")
        comp = scratch.save(components(links, scratch, python), "comp")
        if last:
            break
        open_before = tot[1]
        rows = rows.join(keys.select("key", "p"), "key").where("id <> p.id").select("key", "id", *extra)
        # the tables of the round before are not read again
        scratch.drop(*old)
        scratch.free()
        old = [rows_table, keys]
    if comp is None:
        comp = spark.createDataFrame([], "id bigint, comp bigint")
    return comp, links
