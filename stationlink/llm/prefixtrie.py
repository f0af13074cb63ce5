"""Prefix trie of conversations, with subtree totals by centroid decomposition.

1. One sort of the turn hashes by (conversation, turn) numbers the turns of each
   conversation; a long conversation spans partitions, its later parts are offset.
2. The key of a prefix is two 64-bit xors over the hashes of (place, turn): an associative
   sum, so that prefixes of a long conversation are made block by block. Two different
   prefixes of the same depth share a key with probability 2^-128. One aggregate over the
   keys makes the nodes; a node is named by its smallest member and its depth.
3. Subtree totals follow the parent edges. While a component of the forest is larger than
   ``IN_TASK`` nodes, a round of joins splits it: its centroid (the smallest subtree that
   holds half of it) leaves, the totals of the parts below are aggregated, and their sum is
   added to all nodes on the path from the centroid to the top of the component. What
   stays above and each part below are components of their own. Components that fit a
   task are split on in the same way there, all components of a task in each step. Every
   descendant is counted once for each node above it: when a centroid parts the two.

No conversation, node or component is gathered in one task unless it is below ``IN_TASK``
nodes; the members that end in a node are hashed in ascending order from chunks, with
constant memory.

Null roles and texts are empty; turns of one conversation that share a number (or null,
which comes first) are ordered by the hashes of role and text. Rows without a conv_id
belong to no conversation. A table without conversations has no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, python_workers, read

SHARED = 6            # at most SHARED - 1 turns come from the base conversation
BASE = 100            # conversation c takes them from c - c % BASE
BLOCK = 1024          # turns of a conversation that are summed in one window
IN_TASK = 200_000     # nodes of components that are split on in a task
FEW = 100_000         # rows (24 bytes each) that are broadcast
CHUNK = 8_192         # ids that are joined to one text before they are hashed


# ---- rebuilt conversations ----------------------------------------------------------

def numbered(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos, r1, r2, chars): the turns of each conversation numbered from 1."""
    t = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    t = t.select("conv_id", "turn", F.xxhash64("role", "text").alias("r1"), F.xxhash64("text", "role", F.lit(1)).alias("r2"),
                 F.length("text").cast("long").alias("chars"))
    order = ["conv_id", F.asc_nulls_first("turn"), "r1", "r2"]
    # equal keys stay together in a range; the row number within the sorted partition is in the low 33 bits
    t = t.repartitionByRange(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    t = scratch.save(t.drop("turn").withColumn("at", F.monotonically_increasing_id()), "sorted").withColumn("part", F.shiftright("at", 33))
    spans = t.groupBy("conv_id", "part").agg(F.min("at").alias("lo"), F.count("*").alias("n"))
    spans = spans.withColumn("before", F.expr("coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    return scratch.save(t.join(spans, ["conv_id", "part"]).select("conv_id", F.expr("at - lo + 1 + before").alias("pos"), "r1", "r2", "chars"), "numbered")


def rebuilt(own: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length, first) of each rebuilt conversation, and its turns (conv_id, depth,
    r1, r2, chars): the shared turns of the base, then its own turns after as many."""
    first = own.where(F.col("pos") < SHARED).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "r1", "r2", "chars"))).alias("base"))
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED)
    convs = convs.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % BASE).join(first.withColumnRenamed("conv_id", "base_id"), "base_id", "left")
    convs = convs.select("conv_id", "h", "n", F.expr("slice(coalesce(base, array()), 1, CAST(h AS INT))").alias("base"))
    convs = convs.withColumn("length", F.expr("size(base) + greatest(n - h, 0)"))
    convs = scratch.save(convs, "convs")
    shared = convs.select("conv_id", F.inline("base")).withColumnRenamed("pos", "depth")
    rest = own.join(convs.select("conv_id", "h", F.size("base").alias("k")), "conv_id").where("pos > h").select(
        "conv_id", F.expr("pos - h + k").alias("depth"), "r1", "r2", "chars")
    return convs.select("conv_id", "length"), shared.unionByName(rest)


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars): the key of each prefix and of the one before."""
    t = turns.select("conv_id", "depth", "chars", F.xxhash64("depth", "r1").alias("h1"), F.xxhash64("r2", "depth").alias("h2"),
                     F.expr(f"(depth - 1) DIV {BLOCK}").alias("block"))
    t = scratch.save(t, "rebuilt")
    # conversations of one block need no sums of blocks before
    sums = t.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    long = scratch.save(t.where(f"depth = {BLOCK + 1}").select("conv_id"), "long")
    sums = sums.join(long, "conv_id", "left_semi")
    before = "OVER (PARTITION BY conv_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sums = sums.select("conv_id", "block", F.expr(f"bit_xor(b1) {before}").alias("b1"), F.expr(f"bit_xor(b2) {before}").alias("b2")).where("block > 0")
    within = "OVER (PARTITION BY conv_id, block ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    t = t.select("*", F.expr(f"bit_xor(h1) {within}").alias("w1"), F.expr(f"bit_xor(h2) {within}").alias("w2"))
    t = t.join(sums, ["conv_id", "block"], "left")
    k1, k2 = (F.expr(f"{w} ^ coalesce({b}, 0L)") for w, b in (("w1", "b1"), ("w2", "b2")))
    t = t.select("conv_id", "depth", "chars", k1.alias("k1"), k2.alias("k2"), "h1", "h2")
    return scratch.save(t.select("conv_id", "depth", "k1", "k2", F.expr("k1 ^ h1").alias("p1"), F.expr("k2 ^ h2").alias("p2"), "chars"), "prefixes")


# ---- members that end in a node -----------------------------------------------------

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one node, sorted: its ids joined by commas, at most CHUNK a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in range(4)]
        d, k1, k2, conv = cols
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        starts = np.flatnonzero(new).tolist()
        cuts = [x for a, b in zip(starts, [*starts[1:], len(d)], strict=True) for x in range(a, b, CHUNK)]
        text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts, [*cuts[1:], len(d)], strict=True)]
        yield pa.record_batch([*(pa.array(c[cuts]) for c in cols), pa.array(text, pa.string())], names=["depth", "k1", "k2", "first", "ids"])


def _sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each node from its chunks in order."""
    key, state, out = None, None, []

    def rows() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 3 + (pa.string(),), strict=True)], names=["depth", "k1", "k2", "sha"])

    for batch in batches:
        for *k, ids in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(4).to_pylist(), strict=True):
            if k == key:
                state.update(b",")
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield rows()
            out = []
    if key:
        out = [(*key, state.hexdigest())]
        yield rows()


def ending(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """(depth, k1, k2, sha): SHA-256 of the ascending ids (conv_id) of each node in ``ends``."""
    key, parts = ["depth", "k1", "k2"], int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    rows = ends.select(*key, "conv_id").repartitionByRange(parts, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    rows = rows.mapInArrow(_chunks, "depth long, k1 long, k2 long, first long, ids string")
    return rows.repartition(parts, *key).sortWithinPartitions(*key, "first").mapInArrow(_sha, "depth long, k1 long, k2 long, sha string")


# ---- rollup -------------------------------------------------------------------------

def split_in_task(top: np.ndarray, parent: np.ndarray, leaf: np.ndarray, saved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subtree totals of a forest in one task. ``top`` labels the components, ``parent`` is
    the row of the parent within the component (-1: none); parents stand before children."""
    n = len(parent)
    size, start, nxt = [1] * n, [0] * n, [0] * n
    up = parent.tolist()
    for v in range(n - 1, -1, -1):
        if up[v] >= 0:
            size[up[v]] += size[v]
    free = 0
    for v in range(n):                              # preorder: a subtree is a range
        p = up[v]
        if p < 0:
            start[v], free = free, free + size[v]
        else:
            start[v] = nxt[p]
            nxt[p] += size[v]
        nxt[v] = start[v] + 1
    start, size = np.array(start, np.int64), np.array(size, np.int64)
    end, weights, totals = start + size, np.stack([leaf, saved]), np.zeros((2, n), np.int64)
    label, alive, held = top.copy(), np.ones(n, bool), size.copy()
    while alive.any():
        rows = np.flatnonzero(alive)
        _, comp, count = np.unique(label[rows], return_inverse=True, return_counts=True)
        # the centroid: the smallest subtree with half of its component
        half = np.flatnonzero(2 * held[rows] >= count[comp])
        order = half[np.lexsort((-start[rows[half]], held[rows[half]], comp[half]))]
        _, at = np.unique(comp[order], return_index=True)
        centre = rows[order[at]]
        mine = centre[comp]
        below = (start[rows] > start[mine]) & (start[rows] < end[mine])
        on_path = (start[rows] <= start[mine]) & (start[mine] < end[rows])
        # the part below that a node goes to starts at the last child of the centroid before it
        child = np.flatnonzero(below & (parent[rows] == mine))
        child = child[np.lexsort((start[rows[child]], comp[child]))]
        place, where = comp[child] * (n + 1) + start[rows[child]], comp[below] * (n + 1) + start[rows[below]]
        part = np.searchsorted(place, where, "right") - 1
        for t, w in zip(totals, weights, strict=True):
            parts = np.zeros(len(child), np.int64)
            np.add.at(parts, part, w[rows[below]])
            add = w[centre].copy()
            np.add.at(add, comp[child], parts)
            t[rows[on_path]] += add[comp[on_path]]
        held[rows[on_path]] -= held[centre][comp[on_path]]
        label[rows[below]] = n + rows[child][part]  # labels of tops are below n or those of their rows
        alive[centre] = False
    return totals[0], totals[1]


def _in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Splits the components of a task, sorted by component and depth, some at a time."""
    held: list[np.ndarray] = []
    size = 0

    def finish(cols: np.ndarray) -> pa.RecordBatch:
        cm, cd, depth, m, pm, leaf, saved = cols
        new = np.ones(len(cm), bool)
        new[1:] = (cm[1:] != cm[:-1]) | (cd[1:] != cd[:-1])
        comp = np.cumsum(new) - 1
        # the row of each parent, by (component, depth, member)
        _, member = np.unique(np.concatenate([m, pm]), return_inverse=True)
        mine, theirs = member[:len(m)], member[len(m):]
        order = np.lexsort((mine, depth, comp))     # as sorted already
        code = np.stack([comp, depth, mine])[:, order]
        rank = np.concatenate([[0], np.cumsum((code[:2, 1:] != code[:2, :-1]).any(axis=0))]) if len(cm) else np.zeros(0, np.int64)
        levels = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
        level_of = {(c, d): i for i, (c, d) in enumerate(zip(code[0][levels].tolist(), code[1][levels].tolist(), strict=True))}
        above = np.array([level_of.get((c, d - 1), -1) for c, d in zip(code[0][levels].tolist(), code[1][levels].tolist(), strict=True)])
        wide = len(member) + 1
        key, want = rank * wide + code[2], above[rank] * wide + theirs[order]
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        parent = np.where((above[rank] >= 0) & (key[at] == want), at, -1)
        a, b = split_in_task(comp[order], parent, leaf[order], saved[order])
        return pa.record_batch([pa.array(m[order]), pa.array(depth[order]), pa.array(a), pa.array(b)], names=["m", "depth", "n_leaves", "saved_tokens"])

    for batch in batches:
        if batch.num_rows:
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            size += batch.num_rows
        if size >= IN_TASK:
            cols = np.concatenate(held, axis=1)
            cut = np.flatnonzero((cols[0] != cols[0, -1]) | (cols[1] != cols[1, -1]))
            if len(cut):                            # the last component may go on
                yield finish(cols[:, :cut[-1] + 1])
                cols = cols[:, cut[-1] + 1:]
            held, size = [cols], cols.shape[1]
    if size:
        yield finish(np.concatenate(held, axis=1))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast up to ``FEW`` rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def rollup(nodes: DataFrame, path: DataFrame, scratch: Scratch, in_task: int = IN_TASK) -> DataFrame:
    """(m, depth, n_leaves, saved_tokens): sums of ``leaf`` and ``saved`` over the subtree of
    every node (m, depth, pm, leaf, saved, size); ``size`` counts the nodes of its subtree.
    ``path`` (conv_id, depth, m, pm) names the node of each prefix of the members m."""
    done, added = [], []
    size = nodes.where("depth = 0").select("size", "m").first()
    live = nodes.withColumns({"cm": F.lit(size.m), "cd": F.lit(0).cast("long"), "of": F.lit(size.size)})
    cols = ["m", "depth", "pm", "leaf", "saved", "size", "cm", "cd", "of"]
    while True:
        done.append(live.where(F.col("of") <= in_task).select("cm", "cd", "depth", "m", F.coalesce("pm", F.lit(-1)).alias("pm"), "leaf", "saved"))
        if size.size <= in_task:
            break
        live = live.where(F.col("of") > in_task)
        centre = live.where("2 * size >= of").groupBy("cm", "cd").agg(F.min_by(F.struct("m", "depth", "size", "leaf", "saved"), F.struct("size", -F.col("depth"))).alias("c"))
        centre = scratch.save(centre.select("cm", "cd", F.col("c.m").alias("xm"), F.col("c.depth").alias("xd"), F.col("c.size").alias("xs"),
                                            F.col("c.leaf").alias("xl"), F.col("c.saved").alias("xw")), "centre")
        if centre.isEmpty():
            break
        x = live.join(_small(centre.select("cm", "cd", "xm", "xd", "xs")), ["cm", "cd"]).where("NOT (m = xm AND depth = xd)")
        # the child of the centroid above a node: the prefix of the node's member that is one longer than the centroid
        step = path.select(F.col("conv_id").alias("m"), (F.col("depth") - 1).alias("xd"), F.col("m").alias("ym"), F.col("pm").alias("ypm"))
        x = x.join(step, ["m", "xd"], "left").withColumn("below", F.expr("depth > xd AND coalesce(ypm = xm, false)"))
        x = scratch.save(x.withColumns({"nm": F.expr("IF(below, ym, cm)"), "nd": F.expr("IF(below, xd + 1, cd)")}), "parted")
        parts = scratch.save(x.groupBy("nm", "nd").agg(F.count("*").alias("of"), F.sum("leaf").alias("sl"), F.sum("saved").alias("sw"), F.max("below").alias("below"),
                                                       F.first("cm").alias("cm"), F.first("cd").alias("cd")), "parts")
        total = parts.where("below").groupBy("cm", "cd").agg(F.sum("sl").alias("sl"), F.sum("sw").alias("sw"))
        total = centre.join(total, ["cm", "cd"], "left").selectExpr("cm", "cd", "xm", "xd", "xs", "xl + coalesce(sl, 0) AS sl", "xw + coalesce(sw, 0) AS sw")
        up = path.select("conv_id", "depth", "m").join(_small(scratch.save(total, "total")).withColumnRenamed("xm", "conv_id"), "conv_id").where("depth BETWEEN cd AND xd")
        up = scratch.save(up.select("m", "depth", "xs", F.col("sl").alias("n_leaves"), F.col("sw").alias("saved_tokens")), "path")
        added.append(up.drop("xs"))
        live = x.drop("cm", "cd", "of").join(_small(parts.select("nm", "nd", "of")), ["nm", "nd"]).join(_small(up.select("m", "depth", "xs").withColumnRenamed("xs", "minus")), ["m", "depth"], "left")
        live = live.withColumn("size", F.expr("size - coalesce(minus, 0)")).withColumnsRenamed({"nm": "cm", "nd": "cd"})
        live = scratch.save(live.select(*cols), "live")
        scratch.drop(x)
    rows = done[0]
    for d in done[1:]:
        rows = rows.unionByName(d)
    rows = rows.repartition("cm", "cd").sortWithinPartitions("cm", "cd", "depth", "m")
    out = rows.mapInArrow(_in_task, "m long, depth long, n_leaves long, saved_tokens long")
    for a in added:
        out = out.unionByName(a)
    return out.groupBy("m", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")) if added else out


# ---- the operator -------------------------------------------------------------------

def _keys(df: DataFrame, names: list[str]) -> list[Column]:
    return [F.col(c).alias(n) for c, n in zip(["depth", "k1", "k2"], names, strict=True)]


def conversation_trie(turns: DataFrame, in_task: int = IN_TASK) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256."""
    spark = turns.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "trie")
    convs, built = rebuilt(numbered(turns, scratch), scratch)
    rows = prefixes(built, scratch)
    key = ["depth", "k1", "k2"]
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("m"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "m", "n_convs", zero.alias("chars"), zero.alias("p1"), zero.alias("p2"))
    nodes = rows.groupBy(*key).agg(F.min("conv_id").alias("m"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
                                   F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = scratch.save(nodes.unionByName(root), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("m").alias("pm"))
    linked = scratch.save(nodes.join(above, ["depth", "p1", "p2"], "left"), "linked")
    children = linked.where("pm IS NOT NULL").groupBy(F.col("pm").alias("m"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    linked = linked.join(children, ["m", "depth"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    linked = scratch.save(linked.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}), "linked")
    total = linked.count()
    small = linked.select("m", "depth", "pm", "leaf", "saved")
    if total <= in_task:
        path, sized = rows, small.withColumn("size", F.lit(total).cast("long"))
    else:
        # the nodes that a conversation names are the deepest of its path: those below a node are counted by its members
        named = linked.groupBy(F.col("m").alias("conv_id")).agg(F.count("*").alias("named"))
        members = convs.join(named, "conv_id").select("conv_id", "length", "named")
        per = rows.select("conv_id", *key).join(members, "conv_id").withColumn("size", F.expr("least(named, length - depth + 1)"))
        sizes = per.groupBy(*key).agg(F.sum("size").alias("size")).unionByName(
            spark.createDataFrame([(0, 0, 0, total)], "depth long, k1 long, k2 long, size long"))
        sized = scratch.save(linked.join(sizes, key).select("m", "depth", "pm", "leaf", "saved", "size"), "sized")
        own = rows.join(members.select("conv_id"), "conv_id", "left_semi").select("conv_id", *key)
        own = own.unionByName(members.select("conv_id", *(zero.alias(k) for k in key)))
        path = scratch.save(own.join(linked.select(*key, "m", "pm"), key).select("conv_id", "depth", "m", "pm"), "path")
    sums = scratch.save(rollup(sized, path, scratch, in_task), "sums") if total else spark.createDataFrame([], "m long, depth long, n_leaves long, saved_tokens long")
    # a conversation ends at its deepest prefix, one without turns at the root
    ends = rows.join(convs.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"]).select(*key, "conv_id").unionByName(
        convs.where("length = 0").select(*(zero.alias(k) for k in key), "conv_id"))
    sha = scratch.save(ending(ends, scratch), "ends")
    out = linked.join(sums, ["m", "depth"], "left").join(sha, key, "left")
    return out.select(F.col("m").alias("conv_id"), "depth", F.col("pm").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read(spark, sf_dir, "conversations"))
