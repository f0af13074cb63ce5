"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A list entry is a key ``host + path prefix``. A url offers as candidates the keys it could
be listed under; the broadcast filter passes those that may be listed, and an equi-join
with the list removes its false positives. The filter has a fixed largest size: a longer
list only passes more candidates on to the join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix, python_workers, read

SEGMENT = 1 << 18          # bits of a segment, built by one task
MAX_SEGMENTS = 1 << 11     # 64 MB at most
BITS_A_KEY = 16
PROBES = 6                 # bits a key sets in its block of 512
MAX_SHAPES = 10_000        # (labels, path length) pairs of rules
BROADCAST_RULES = 100_000

# host and path of each rule and its verdict (fixed values)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block in its segment, bits in the block) of each key hash."""
    g = mix(h.view(np.uint64) if h.dtype == np.int64 else h)
    block = (g >> np.uint64(55)) % np.uint64(SEGMENT // 512)
    shifts = np.uint64(9) * np.arange(PROBES, dtype=np.uint64)
    return block, (g[:, None] >> shifts) & np.uint64(511)


def build_filter(keys: DataFrame) -> tuple[int, bytes]:
    """(segments, bits) of a blocked Bloom filter over the distinct keys in column ``key``.
    Each task builds one segment; what comes to the driver is at most 64 MB."""
    h = keys.select(F.xxhash64("key").alias("h")).where("key IS NOT NULL").distinct()
    n = h.count()
    segments = 1
    while segments < MAX_SEGMENTS and segments * SEGMENT < n * BITS_A_KEY:
        segments *= 2

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(SEGMENT, bool)
        block, at = _bits(pdf["h"].to_numpy())
        bits[(block[:, None] * np.uint64(512) + at).astype(np.int64).ravel()] = True
        return pd.DataFrame({"seg": [int(key[0])], "bits": [np.packbits(bits).tobytes()]})

    rows = h.withColumn("seg", F.expr(f"CAST(h & {segments - 1} AS INT)")).groupBy("seg").applyInPandas(build, "seg int, bits binary").collect()
    out = bytearray(segments * SEGMENT // 8)
    for r in rows:
        out[r.seg * SEGMENT // 8:(r.seg + 1) * SEGMENT // 8] = r.bits
    return segments, bytes(out)


def listed(candidates: DataFrame, entries: DataFrame) -> DataFrame:
    """``candidates`` joined with ``entries`` on ``key``, after the filter of the entries' keys."""
    spark = candidates.sparkSession
    segments, bits = build_filter(entries)
    held = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def may(h: pd.Series) -> pd.Series:
        table = np.frombuffer(held.value, np.uint8)
        v = h.to_numpy(np.int64)
        block, at = _bits(v)
        pos = ((v & (segments - 1)) * SEGMENT)[:, None] + (block[:, None] * np.uint64(512) + at).astype(np.int64)
        return pd.Series((table[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8) & 1).all(axis=1))

    few = entries.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    return candidates.where(may(F.xxhash64("key"))).join(F.broadcast(entries) if few else entries, "key")


def host_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for null or without ``://``."""
    rest = F.expr(f"IF(coalesce(instr({url}, '://'), 0) > 0, substring({url}, instr({url}, '://') + 3), '')")
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def canonical(host: str, path: str) -> Column:
    """Key of one page: host without www., m. or port, path without repeated or final
    slashes, index page and .html."""
    h = F.regexp_replace(F.regexp_replace(host, r":\d*$", ""), r"^(www\d?|m)\.", "")
    p = F.regexp_replace(F.regexp_replace(path, "/+", "/"), r"(/index)?(\.html?)?/?$", "")
    return F.concat(h, p)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, block_list: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row.

    A rule fits its host and all subdomains if the path starts with its own; the longest
    wins (ties of equal length cannot fit one url). Where none fits, a url whose canonical
    form is in ``block_list`` (column ``key``) is blocked, any other allowed; without a
    list it holds the canonical forms of the pages that the rules block, so that their
    mirrors go too. Null urls and such without ``://`` have empty host and path and are
    allowed. Rows that repeat an id or a url each get theirs.
    """
    spark = pages.sparkSession
    python_workers(spark)
    scratch = Scratch(spark, "urlfilter")
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_path("url")
    src = scratch.save(src.select("page_id", host.alias("host"), path.alias("path")), "urls")
    # each distinct place is judged once, a hot one too
    places = src.select("host", "path").where("host <> ''").distinct()
    entries = spark.createDataFrame([(h + p, v, len(h + p)) for h, p, v in rules] or [], "key string, verdict string, size int").distinct()
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p, _ in rules})
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"rules have {len(shapes)} shapes of host and path; {MAX_SHAPES} at most")
    keys = F.array_compact(F.array(*[
        F.expr(f"IF(length(host) - length(replace(host, '.', '')) >= {n - 1} AND length(path) >= {m}, "
               f"concat(substring_index(host, '.', -{n}), substring(path, 1, {m})), NULL)") for n, m in shapes]).cast("array<string>"))
    hits = listed(places.select("host", "path", F.explode(keys).alias("key")), entries)
    ruled = scratch.save(hits.groupBy("host", "path").agg(F.max_by(F.struct("key", "verdict"), "size").alias("r"))
                         .select("host", "path", F.col("r.key").alias("rule"), F.col("r.verdict").alias("by_rule")), "ruled")
    if block_list is None:
        block_list = ruled.where("by_rule = 'block'").select(canonical("host", "path").alias("key"))
    block_list = scratch.save(block_list.select("key").distinct(), "list")
    rest = places.join(ruled, ["host", "path"], "left_anti").select("host", "path", canonical("host", "path").alias("key"))
    blocked = scratch.save(listed(rest, block_list).select("host", "path", F.lit("block").alias("by_list")), "blocked")
    out = src.join(ruled, ["host", "path"], "left").join(blocked, ["host", "path"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_list", F.lit("allow")).alias("verdict"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages").select("page_id", "url"))


# the rules by SQL, and the list of canonical forms that the rules block
ORACLE = r"""
WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                           ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
d AS (SELECT DISTINCT host, path FROM s WHERE host <> ''),
m AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
      FROM d JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path),
c AS (SELECT host, path, regexp_replace(regexp_replace(host, ':\d*$', ''), '^(www\d?|m)\.', '') ||
             regexp_replace(regexp_replace(path, '/+', '/', 'g'), '(/index)?(\.html?)?/?$', '') AS key FROM d),
l AS (SELECT DISTINCT key FROM c JOIN m USING (host, path) WHERE v = 'block')
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN l.key IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM s LEFT JOIN m USING (host, path) LEFT JOIN c USING (host, path) LEFT JOIN l USING (key)
"""
