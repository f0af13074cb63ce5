"""Place lookup in an ordered two-level gazetteer, nearest candidate by L1 distance,
candidate restriction.

No Python UDF and no cross join: the lookup is a higher-order-function scan of a
size-checked literal array (or a substring equi-join for a large gazetteer), the nearest
search goes down a pyramid of occupied cells by joins and is exact."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import GAZETTEER_SCHEMA, SENTINELS
from ..session import checkpoint_dir
from .pyramid import Pyramid

# Gazetteers up to this many entries are inlined into the plan as a literal array.
LITERAL_GAZETTEER_MAX = 5000


def gazetteer_from_nested(spark: SparkSession, nested: dict) -> DataFrame:
    """Flatten ``{region: {city: [lat, lng]}}`` (document order kept as ``ord``) into
    ``ord, wide, narrow, lat, lng``. A sentinel pair becomes null coordinates."""
    rows, ord_ = [], 0
    for wide, cities in nested.items():
        for narrow, coords in cities.items():
            lat = lng = None
            if isinstance(coords, (list, tuple)) and len(coords) == 2 and not any(
                    isinstance(v, str) and v in SENTINELS for v in coords):
                lat, lng = float(coords[0]), float(coords[1])
            rows.append((ord_, wide, narrow, lat, lng))
            ord_ += 1
    return spark.createDataFrame(rows, GAZETTEER_SCHEMA)


def shared_coordinates(gazetteer: DataFrame) -> DataFrame:
    """Data check: coordinates that appear under more than one region (a sign that a bare
    city name was geocoded to a namesake elsewhere). ``lat, lng, regions, entries``."""
    return (gazetteer.where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
            .groupBy("lat", "lng")
            .agg(F.countDistinct("wide").alias("regions"), F.count(F.lit(1)).alias("entries"))
            .where(F.col("regions") > 1))


def _literal_lookup(text: Column, entries: list) -> Column:
    # the entries travel as one JSON text literal; from_json of a literal is folded into
    # one constant array by the optimizer (one driver call instead of one per field)
    doc = json.dumps([{"ord": o, "wide": w, "narrow": n, "lat": la, "lng": ln} for (o, w, n, la, ln) in entries])
    arr = F.from_json(F.lit(doc), T.ArrayType(GAZETTEER_SCHEMA))
    hits = F.filter(arr, lambda e: F.contains(text, e["wide"]) & F.contains(text, e["narrow"]))
    return F.get(hits, 0)


def place_lookup(df: DataFrame, text_col: str, gazetteer, id_col: str | None = None,
                 drop_missing: bool = True, literal_max: int = LITERAL_GAZETTEER_MAX) -> DataFrame:
    """Give each row the first gazetteer entry (by ``ord``) whose region name and city
    name both occur in ``text_col``; ``wide, narrow, lat, lng`` are null when none fits.

    ``gazetteer`` is either the flattened config as a list of ``(ord, wide, narrow, lat,
    lng)`` or a DataFrame of that shape. Up to ``literal_max`` entries (a list's length,
    or one count on the DataFrame) it is inlined as a literal array (no join, no
    shuffle); above it an index of rare grams is joined (``id_col`` is not needed)."""
    if drop_missing:
        df = df.where(F.col(text_col).isNotNull())
    if not isinstance(gazetteer, DataFrame):
        entries = sorted((tuple(e) for e in gazetteer), key=lambda e: e[0])
        if len(entries) > literal_max:
            gazetteer = df.sparkSession.createDataFrame(entries, GAZETTEER_SCHEMA)
            return _substring_join_lookup(df, text_col, gazetteer)
    elif gazetteer.count() <= literal_max:
        entries = [tuple(r) for r in gazetteer.select("ord", "wide", "narrow", "lat", "lng").orderBy("ord").collect()]
    else:
        return _substring_join_lookup(df, text_col, gazetteer)
    if not entries:
        return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in
                                (("wide", "string"), ("narrow", "string"), ("lat", "double"), ("lng", "double"))])
    hit = _literal_lookup(F.col(text_col), entries)
    return df.withColumn("_hit", hit).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_hit.wide").alias("wide"), F.col("_hit.narrow").alias("narrow"),
        F.col("_hit.lat").alias("lat"), F.col("_hit.lng").alias("lng"))


# Grams of names: at most this many characters. Words are cut into pieces of this many
# start positions before their grams are listed: the array built for one word stays that
# size times the gram lengths, however long the word is.
GRAM = 3
SUBSTRING_PIECE = 512
SPACES = r"\\s"              # SQL text of the pattern that ends a word, in texts and in names alike
BROADCAST_BYTES = 32 << 20  # of words with their entries, or of grams, that are broadcast
COMMON_WORDS = 1000         # an entry of more words that are in many texts is tried on every text


def _substring_join_lookup(df: DataFrame, text_col: str, gaz: DataFrame, id_col: str | None = None,
                           piece: int = SUBSTRING_PIECE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The lookup by an index of rare grams, for any number of entries: region and city
    are looked for together, under the gram of either name that the fewest texts hold
    (of its longest grams; none spans a space). Grams are listed once per distinct word of
    all texts, not per text: the words that hold an entry's gram, and the part of the name
    around it, stand for the entry. Texts meet the entries of their words by an equi-join
    and ``contains`` confirms; a common name costs nothing unless its entry's rarest gram is
    common too. Texts are told apart by a 64-bit hash: ids play no part. An empty name is in
    every text, a null one in none."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    # of entries with the same names only the first can be found
    gaz = gaz.where("ord IS NOT NULL AND wide IS NOT NULL AND narrow IS NOT NULL").groupBy("wide", "narrow").agg(
        F.min(F.struct("ord", "lat", "lng")).alias("entry"))
    text = df.select(F.xxhash64(text_col).alias("_t"), F.col(text_col).alias("_s")).where("_s IS NOT NULL")
    # every text has the empty word: under it stand entries without a gram
    words = F.explode(F.expr(f"array_distinct(concat(split(_s, '{SPACES}'), array('')))")).alias("word")

    def listed(c: str, q: str) -> str:
        return f"IF(length({c}) < {q}, CAST(array() AS ARRAY<STRING>), transform(sequence(1, length({c}) - {q} + 1), i -> substring({c}, i, {q})))"

    names = f"filter(concat(split(wide, '{SPACES}'), split(narrow, '{SPACES}')), p -> p <> '')"
    of_names = F.array_distinct(F.expr(f"flatten(transform({names}, p -> {listed('p', f'least({GRAM}, length(p))')}))"))
    grams = gaz.select("wide", "narrow", of_names.alias("g")).select(
        "wide", "narrow", F.explode(F.expr("IF(size(g) = 0, array(''), filter(g, x -> length(x) = array_max(transform(g, y -> length(y)))))")).alias("gram"))
    grams = grams.checkpoint(eager=True)
    wanted = grams.select("gram").distinct()

    def few(x: DataFrame, *cols: str) -> bool:
        return (x.agg(F.sum(F.expr("50 + " + " + ".join(f"octet_length({c})" for c in cols)))).first()[0] or 0) <= broadcast_bytes

    lens = sorted(r[0] for r in wanted.select(F.length("gram")).distinct().collect())       # 0 .. GRAM
    vocabulary = text.select(words).groupBy("word").agg(F.count("*").alias("n"))
    pieces = vocabulary.select("word", "n", F.explode(F.expr(
        f"transform(sequence(0, greatest((length(word) - 1) DIV {piece}, 0)), k -> substring(word, CAST(k * {piece} + 1 AS INT), {piece + GRAM - 1}))")).alias("_p"))
    every = ", ".join(listed("_p", str(q)) if q else "IF(word = '', array(''), CAST(array() AS ARRAY<STRING>))" for q in lens) or "CAST(array() AS ARRAY<STRING>)"
    found = pieces.select("word", "n", F.explode(F.array_distinct(F.expr(f"concat({every})"))).alias("gram"))
    found = found.join(F.broadcast(wanted) if few(wanted, "gram") else wanted, "gram", "left_semi").distinct().checkpoint(eager=True)
    texts_of = found.groupBy("gram").agg(F.sum("n").alias("n"))
    # an entry with a gram that no text has drops out here
    rarest = grams.join(texts_of, "gram", "left").groupBy("wide", "narrow").agg(
        F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    near = found.join(rarest, "gram").where(f"exists({names}, p -> contains(p, gram) AND contains(word, p)) OR gram = ''").select("word", "wide", "narrow", "n")
    near = near.checkpoint(eager=True)
    n_texts = text.count()
    common = near.groupBy("wide", "narrow").agg(F.count("*").alias("k"), F.sum("n").alias("n")).where(
        (F.col("k") > COMMON_WORDS) & (F.col("n") > n_texts / 4)).select("wide", "narrow")
    places = near.select("word", "wide", "narrow").join(common, ["wide", "narrow"], "left_anti").unionByName(common.select(F.lit("").alias("word"), "wide", "narrow"))
    places = places.join(gaz, ["wide", "narrow"]).checkpoint(eager=True)
    if few(places, "word", "wide", "narrow"):
        hits = text.select("_t", "_s", words).join(F.broadcast(places), "word")
    else:
        # texts are not copied for each of their words: the pairs are made without them
        hits = text.select("_t", words).join(places, "word").select("_t", "wide", "narrow", "entry").distinct()
        read = text.join(hits.select("_t").distinct(), "_t", "left_semi").groupBy("_t").agg(F.first("_s").alias("_s"))
        hits = hits.join(read, "_t")
    hits = hits.where("contains(_s, wide) AND contains(_s, narrow)").groupBy("_t").agg(
        F.min(F.struct("entry.ord", "wide", "narrow", "entry.lat", "entry.lng")).alias("_hit"))
    return df.withColumn("_t", F.xxhash64(text_col)).join(hits, "_t", "left").select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.when(F.col(text_col).isNotNull(), F.col(f"_hit.{c}")).alias(c) for c in ("wide", "narrow", "lat", "lng")])


def active_candidates(stations: DataFrame, facts: DataFrame, key: str, fact_key: str | None = None,
                      order_col: str | None = None) -> DataFrame:
    """Stations whose ``key`` occurs in ``facts``, one row per key: the row with the
    lowest ``order_col`` (deterministic, unlike ``dropDuplicates``).

    The fact keys are made distinct first (partial aggregation on the map side), so a
    huge fact table with few keys shuffles only a few rows."""
    fact_key = fact_key or key
    keys = facts.select(F.col(fact_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    present = stations.join(keys, key, "left_semi")
    order_col = order_col or key
    others = [c for c in stations.columns if c != key]
    best = present.groupBy(key).agg(F.min_by(F.struct(*others), F.col(order_col)).alias("_b"))
    return best.select(key, *[F.col(f"_b.`{c}`").alias(c) for c in others])


def nearest_l1(queries: DataFrame, cands: DataFrame, q_id: str, q_x: str, q_y: str,
               c_x: str, c_y: str, c_ord: str, c_cols: list, wx: float = 1.0, wy: float = 1.0,
               per_cell: float = 4.0, dense_factor: float = 4.0) -> DataFrame:
    """For each query row, the candidate with the least ``wx*|dx| + wy*|dy|``; a tie goes
    to the lowest ``c_ord``. Returns ``q_id, <c_cols>, distance``; one row per query row
    (nulls when the query has no finite coordinates or there is no candidate).

    Exact search in a pyramid of the cells that hold candidates (see ``pyramid``); a cell
    of more than ``per_cell * dense_factor`` candidates is split. The search runs once per
    distinct query point and is joined back to the queries.

    Actions: the statistics and levels of the pyramid, and a checkpoint of the first
    distances (lineage is cut in ``spark.checkpoint.dir``)."""
    # a candidate without finite coordinates (null, NaN, infinite) can be nearest to nothing
    def finite(*cols):
        return F.expr(" AND ".join(f"abs(double(`{c}`)) < double('Infinity')" for c in cols))

    pcols = [f"_p_{c}" for c in c_cols]
    cand = cands.where(finite(c_x, c_y)).select(
        F.col(c_ord).alias("_ord"), F.col(c_x).cast("double").alias("_x"), F.col(c_y).cast("double").alias("_y"),
        *[F.col(c).alias(p) for c, p in zip(c_cols, pcols, strict=True)])
    # candidates at the very same point: only the lowest ord can ever win
    cand = (cand.groupBy("_x", "_y")
            .agg(F.min_by(F.struct("_ord", *pcols), F.col("_ord")).alias("_b"))
            .select("_x", "_y", "_b.*"))
    checkpoint_dir(queries.sparkSession)
    tree = Pyramid(cand, per_cell * dense_factor, wx, wy)
    q = queries.select(F.col(q_id).alias("_id"), F.col(q_x).cast("double").alias("_qx"), F.col(q_y).cast("double").alias("_qy"))
    if not tree.n:
        return q.select(F.col("_id").alias(q_id), *[F.lit(None).cast(cands.schema[c].dataType).alias(c) for c in c_cols],
                        F.lit(None).cast("double").alias("distance"))
    # many queries share a point (places come from a gazetteer; a third of all rows may
    # sit on one coordinate): each distinct point is searched once (map-side partial
    # distinct), so a hot point costs one search, not one per row
    found = tree.nearest(q.where(finite("_qx", "_qy")).select("_qx", "_qy").distinct())
    found = found.select("_qx", "_qy", *[F.col(f"_m.{p}").alias(c) for c, p in zip(c_cols, pcols, strict=True)], F.col("_m._d").alias("distance"))
    # every query gets its point's match; a query without coordinates finds no point
    # and keeps nulls. AQE broadcasts the found side when small and splits a hot point's
    # partition otherwise
    return q.join(found, ["_qx", "_qy"], "left").select(F.col("_id").alias(q_id), *c_cols, "distance")
