"""Driver queries: each applies the library operators to the given tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB SQL over
the same tables) return the same columns with the same names. Money and counts are
summed as integers (cents), so results do not depend on the order of a double sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import binarize, json_field, not_sentinel, parse_date, strip_ws, typed_null
from ..operators import features as feat
from ..operators import geo, marks, model, panel
from ..schemas import GAZETTEER_SCHEMA, SEED
from ..sources.envelope import check_range_args, extract_range, unwrap_envelope
from ..sources.pages import READING_SERVICE, flatten_responses, outbreak_service, page_completeness, parse_responses, rows_or_sentinel
from ..sources.rejects import bad_date, bad_document, bad_number, left_out, measured, rejected
from ..sources.sinks import complete_years, json_records
from ..sources.tables import TABLES, read_table
from ..session import scratch_folder
from ..streaming.daystore import DayStore
from .fixtures import part_gazetteer
from .incremental import land

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
RANGE_LO, RANGE_HI = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
TARGET_THRESHOLD = 100000
REPORT_THRESHOLD = 500


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint")


def _events_daily(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return ev.where(not_sentinel(F.col("event_type"))).select(
        F.to_date("ts").alias("day"), "user_id", "event_type", _cents("value").alias("cents"))


# q01 -------------------------------------------------------------------------
def q01_envelope_unwrap(spark, d):
    ev = read_table(spark, d, "events")
    env = ev.select(F.col("event_id").alias("id"), F.col("props").alias("json_data"),
                    F.col("ts").alias("execute_date"))
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    out = unwrap_envelope(env, schema, keep=("id", "execute_date"))
    return out.select(F.col("id").alias("event_id"), "k", F.col("execute_date").alias("ts"))


# q02 -------------------------------------------------------------------------
def q02_date_normalize(spark, d):
    o = read_table(spark, d, "orders")
    txt = F.date_format("o_orderdate", "yyyyMMdd")
    return o.select("o_orderkey", txt.alias("d_text"), parse_date(txt, "%Y%m%d").alias("newdate"))


# q03 -------------------------------------------------------------------------
def q03_page_flatten(spark, d):
    c = read_table(spark, d, "conversations")
    rows = c.where((F.col("role") == "user") & (F.length("text") > 200)).select("conv_id", "turn", "text")
    return rows_or_sentinel(c, rows, ["conv_id"], {"text": "no_data"})


# q04 -------------------------------------------------------------------------
def q04_station_enrich(spark, d):
    s = read_table(spark, d, "supplier")
    n = read_table(spark, d, "nation")
    master = n.where(F.col("n_regionkey") != 4)  # region 4 plays the closed stations
    out = panel.enrich_left(s.select("s_suppkey", "s_name", "s_nationkey"), master,
                            "s_nationkey", "n_nationkey", ["n_name", "n_regionkey"])
    return out.withColumn("station", typed_null("string"))


# q05 -------------------------------------------------------------------------
def q05_active_candidates(spark, d):
    s = read_table(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_name", "s_acctbal")
    c = read_table(spark, d, "customer")
    n = read_table(spark, d, "nation")
    cand = geo.active_candidates(s, c, "s_nationkey", fact_key="c_nationkey", order_col="s_suppkey")
    return panel.enrich_left(cand, n, "s_nationkey", "n_nationkey", ["n_name"])


# q06 -------------------------------------------------------------------------
def q06_place_lookup(spark, d):
    p = read_table(spark, d, "part").select("p_partkey", "p_name")
    return geo.place_lookup(p, "p_name", part_gazetteer(), id_col="p_partkey")


# q07 -------------------------------------------------------------------------
def q07_nearest_l1(spark, d):
    c = read_table(spark, d, "customer")
    s = read_table(spark, d, "supplier")
    out = geo.nearest_l1(c, s, "c_custkey", "c_acctbal", "c_nationkey", "s_acctbal", "s_nationkey",
                         "s_suppkey", ["s_suppkey"], wx=1.0, wy=100.0)
    return out.withColumn("distance", F.round("distance", 4))


# q08 -------------------------------------------------------------------------
def q08_pivot_sum(spark, d):
    e = _events_daily(spark, d)
    return panel.pivot_sum(e, ["day", "user_id"], "event_type", "cents", EVENT_TYPES, fill=0)


# q09 (flagship) ----------------------------------------------------------------
def q09_panel(spark, d):
    """Daily (day, user) readings from the views, left-joined with the pivot of the other
    event types on both keys, then enriched from the customer master. Both sides of the
    panel join are aggregated on the join keys, so the join adds no shuffle."""
    e = _events_daily(spark, d)
    views = (e.where(F.col("event_type") == "view").groupBy("day", "user_id")
             .agg(F.count(F.lit(1)).alias("n_views"), F.sum("cents").cast("bigint").alias("view_cents")))
    others = [t for t in EVENT_TYPES if t != "view"]
    pv = panel.pivot_sum(e.where(F.col("event_type") != "view"), ["day", "user_id"], "event_type", "cents",
                         others, fill=0)
    pan = panel.panel_join(views, pv, ["day", "user_id"])
    cust = read_table(spark, d, "customer")
    return panel.enrich_left(pan, cust, "user_id", "c_custkey", ["c_nationkey", "c_mktsegment"])


# q10 -------------------------------------------------------------------------
def q10_missing_keys(spark, d):
    o = read_table(spark, d, "orders")
    li = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return panel.missing_keys(o, li, ["o_orderkey"])


# q11 -------------------------------------------------------------------------
def q11_trim_join(spark, d):
    p = read_table(spark, d, "part")
    left = p.select("p_partkey", F.expr("repeat(' ', p_size % 3) || p_brand || repeat(char(9), p_size % 2)")
                    .alias("brand"))
    right = (p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts"), F.sum("p_size").cast("bigint").alias("sum_size"))
             .select(F.concat(F.lit(" "), "p_brand", F.lit("  ")).alias("brand"), "n_parts", "sum_size"))
    return panel.trim_keys(left, ["brand"]).join(panel.trim_keys(right, ["brand"]), "brand")


# q12 -------------------------------------------------------------------------
def q12_range_extract(spark, d):
    check_range_args("events", RANGE_LO.replace("-", "").replace(" ", "").replace(":", ""),
                     RANGE_HI.replace("-", "").replace(" ", "").replace(":", ""), TABLES)
    ev = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    return extract_range(ev, RANGE_LO, RANGE_HI, ts_col="ts", order_cols=("event_id",))


# q13 -------------------------------------------------------------------------
def q13_high_water(spark, d):
    ev = read_table(spark, d, "events")
    return marks.high_water(ev, "ts", by=["user_id"],
                            extra=[F.max(json_field(F.col("props"), "$.k", "int")).alias("max_k")])


# q14 -------------------------------------------------------------------------
def _flag_status_targets():
    return [f + s for f in ("A", "N", "R") for s in ("F", "O")]


def q14_target_filter(spark, d):
    li = read_table(spark, d, "lineitem")
    wide = li.select(*[F.when((F.col("l_returnflag") == t[0]) & (F.col("l_linestatus") == t[1]),
                              F.col("l_quantity")).alias(t) for t in _flag_status_targets()])
    return feat.select_targets(wide, _flag_status_targets(), TARGET_THRESHOLD)


# q15 -------------------------------------------------------------------------
def q15_iqr_filter(spark, d):
    ev = read_table(spark, d, "events")
    df = ev.select("event_id", "value", (F.col("value") * json_field(F.col("props"), "$.k", "int")).alias("vk"))
    return feat.iqr_filter(df, ["value", "vk"])


# q16 -------------------------------------------------------------------------
def q16_replicate(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return feat.replicate(li, "l_linenumber", "copy")


# q17 -------------------------------------------------------------------------
def q17_binarize(spark, d):
    ev = read_table(spark, d, "events")
    y = F.coalesce(F.floor(F.col("value") / 10).cast("int") - 1, F.lit(0))
    return ev.select("event_id", y.alias("y")).withColumn("label", binarize(F.col("y")))


# q18 -------------------------------------------------------------------------
def _labeled_docs(spark, d):
    docs = read_table(spark, d, "documents")
    lab = read_table(spark, d, "labels")
    return docs.join(lab, "doc_id")


def q18_undersample(spark, d):
    df = _labeled_docs(spark, d).select("doc_id", "toxic", "n_chars")
    return feat.undersample(df, "toxic", ["doc_id"], classes=(0, 1), seed=SEED)


# q19 -------------------------------------------------------------------------
def q19_split(spark, d):
    df = _labeled_docs(spark, d).select("doc_id", "quality")
    return feat.split_train_test(df, "quality", ["doc_id"], 0.2, SEED)


# q20 -------------------------------------------------------------------------
Z_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


def q20_standardize(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *Z_FEATURES)
    sp = feat.split_train_test(li, "l_returnflag", ["l_orderkey", "l_linenumber"], 0.2, SEED)
    z = feat.standardize(sp, Z_FEATURES, fit_on=F.col("split") == "train", digits=4)
    return z.select("l_orderkey", "l_linenumber", "split", *[f + "_z" for f in Z_FEATURES])


# q21 -------------------------------------------------------------------------
DOC_FEATURES = ["n_chars", "n_words", "n_lines"]


def _doc_features(spark, d):
    docs = _labeled_docs(spark, d)
    return docs.select("doc_id", "quality", "toxic",
                       F.col("n_chars").cast("double").alias("n_chars"),
                       F.size(F.split(F.trim("text"), r"\s+")).cast("double").alias("n_words"),
                       F.size(F.split("text", "\n")).cast("double").alias("n_lines"))


def q21_gbt_score(spark, d):
    """One boosted-tree model per target (two targets): exact stratified split, scaler and
    model fitted on the training rows, test rows scored."""
    base = _doc_features(spark, d)

    def fit_one(target):
        sp = feat.split_train_test(base.select("doc_id", target, *DOC_FEATURES), target, ["doc_id"], 0.2, SEED)
        _, scored = model.fit_and_score(sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test"),
                                        DOC_FEATURES, target)
        return scored.select(F.lit(target).alias("target"), "doc_id", F.col(target).cast("int").alias("label"),
                             F.col("prediction").cast("int").alias("prediction"), F.round("score", 6).alias("score"))

    parts = model.fit_per_target(fit_one, ["quality", "toxic"])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# q22 -------------------------------------------------------------------------
def q22_auc(spark, d):
    df = _labeled_docs(spark, d).select(F.col("n_chars").cast("double").alias("score"),
                                        F.col("quality").alias("y")).na.drop()
    a = model.auc_frame(df, "y", "score")
    return a.select(F.lit("quality").alias("target"), F.round("auc", 6).alias("auc"))


# q23 -------------------------------------------------------------------------
def q23_class_report(spark, d):
    df = _labeled_docs(spark, d).select(F.col("quality").alias("y"),
                                        (F.col("n_chars") > REPORT_THRESHOLD).cast("int").alias("p"))
    rep = model.class_report(df, "y", "p")
    return rep.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


# q24 -------------------------------------------------------------------------
def q24_year_rollover(spark, d):
    li = read_table(spark, d, "lineitem").select("l_shipdate", "l_quantity", "l_extendedprice")
    archived, _live = complete_years(li, "l_shipdate")
    return archived.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.sum("l_quantity").cast("bigint").alias("sum_qty"),
                                        F.sum(_cents("l_extendedprice")).alias("sum_cents"))


# q25 -------------------------------------------------------------------------
def q25_json_records(spark, d):
    n = read_table(spark, d, "nation")
    r = read_table(spark, d, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    return json_records(j, ["n_nationkey", "n_name", "r_name"], keep=["n_nationkey"])


# q26 -------------------------------------------------------------------------
def q26_gap_report(spark, d):
    ev = read_table(spark, d, "events")
    return marks.gap_report(ev, "user_id", "ts")


# q27 -------------------------------------------------------------------------
_USER = T.StructField("user_id", T.LongType())
_SUMS = T.StructType([_USER, T.StructField("event_type", T.StringType()), T.StructField("n", T.LongType()), T.StructField("cents", T.LongType())])
_PANEL = T.StructType([_USER, T.StructField("n_views", T.LongType()), T.StructField("view_cents", T.LongType()),
                       *[T.StructField(t, T.LongType()) for t in EVENT_TYPES if t != "view"]])


def q27_incremental_panel(spark, d):
    """The panel of views and other events after three deliveries of events, whose days
    overlap: each run reads what landed since the one before, adds the partial sums of its
    batches and builds the touched days again; then the complete years are archived."""
    root = scratch_folder(spark, "q27")
    store = DayStore(spark, f"{root}/store", {"sums": _SUMS}, {"panel": _PANEL})
    events = read_table(spark, d, "events")

    def each(rows, number):
        e = rows.select(F.to_date("ts").alias("day"), "user_id", "event_type", _cents("value").alias("cents"))
        store.add("sums", e.groupBy("day", "user_id", "event_type").agg(F.count("*").alias("n"), F.sum("cents").cast("bigint").alias("cents")), number)

    for k in range(3):
        events.where(F.col("event_id") % 3 == k).write.parquet(f"{root}/landed/{k}")
        land(spark, f"{root}/landed/*", f"{root}/progress", each, schema=events.schema, fmt="parquet")
        days = store.pending("sums")
        if days:
            sums = store.rows("sums", days).groupBy("day", "user_id").agg(
                *[F.sum(F.when(F.col("event_type") == "view", F.col(c))).alias(n) for c, n in (("n", "n_views"), ("cents", "view_cents"))],
                *[F.coalesce(F.sum(F.when(F.col("event_type") == t, F.col("cents"))), F.lit(0)).alias(t) for t in EVENT_TYPES if t != "view"])
            store.replace_days("panel", sums.where("n_views > 0"))
        store.commit({"sums": (store.last_batch("sums"), None)})
    store.archive("panel")
    return store.whole("panel").select("day", *_PANEL.fieldNames())


# q28 -------------------------------------------------------------------------
def _two_towns(key: str, x, y):
    """Whole coordinates in two clusters far apart."""
    far = (F.col(key) % 2) * 1000000000
    return [F.col(key), (x + far).cast("double").alias("x"), (y + far).cast("double").alias("y")]


def q28_nearest_clustered(spark, d):
    """The nearest part of each customer: parts lie on slanted lines in two small clusters
    very far apart, some customers far outside."""
    p, c = read_table(spark, d, "part"), read_table(spark, d, "customer")
    cents = _cents("p_retailprice")
    parts = p.select(*_two_towns("p_partkey", cents, F.col("p_size") * 10 - cents))
    balance = _cents("c_acctbal")
    custs = c.select(*_two_towns("c_custkey", F.when(F.col("c_custkey") % 10 == 3, balance * 1000).otherwise(balance), F.col("c_nationkey") * 1000 - balance))
    return geo.nearest_l1(custs, parts, "c_custkey", "x", "y", "x", "y", "p_partkey", ["p_partkey"])


# q29 -------------------------------------------------------------------------
def q29_iqr_selected(spark, d):
    """The sequential filter with quantiles by bracketed selection, as on large tables: one
    feature does not vary, one has few values."""
    li = read_table(spark, d, "lineitem")
    df = li.select("l_orderkey", "l_linenumber", "l_extendedprice", F.lit(7.5).alias("fixed"), "l_quantity", "l_discount")
    return feat.iqr_filter(df, ["l_extendedprice", "fixed", "l_quantity", "l_discount"], k=0.3, max_values=1000)


# q30 -------------------------------------------------------------------------
def q30_place_lookup_indexed(spark, d):
    """Place lookup in documents by the rare-gram index, as for a large gazetteer: an entry
    is the first and the third word of a benchmark item."""
    word = lambda k: F.split_part("text", F.lit(" "), F.lit(k))
    gaz = read_table(spark, d, "benchmark").select(F.col("item_id").cast("int").alias("ord"), word(1).alias("wide"), word(3).alias("narrow"),
                                                   F.col("item_id").cast("double").alias("lat"), F.lit(0.5).alias("lng"))
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return geo.place_lookup(docs, "text", gaz, literal_max=0).drop("text")


# q31 -------------------------------------------------------------------------
def q31_response_pages(spark, d):
    """Long user turns as landed responses of two services with different documents, three
    rows a page, some requests without their later pages: flattened, a sentinel with the
    request's date for those that state no row, and whether each request is complete."""
    c = read_table(spark, d, "conversations").select("conv_id", "turn", (F.coalesce((F.col("role") == "user") & (F.length("text") > 200), F.lit(False))).alias("long"), "text")
    total = c.groupBy("conv_id").agg(F.count_if("long").alias("total"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    paged = c.where("long").select("conv_id", "turn", "text", F.floor(number / 3).alias("page")).groupBy("conv_id", "page").agg(
        F.collect_list(F.struct(F.col("turn").cast("string").alias("tm"), F.col("text").alias("stnNm"))).alias("rows"))
    landed = total.join(paged, "conv_id", "left").where("NOT (conv_id % 7 = 3 AND coalesce(page, 0) > 0)")
    rows = F.coalesce("rows", F.array().cast("array<struct<tm:string,stnNm:string>>"))
    first = F.struct(F.struct(F.struct(F.lit("00").alias("resultCode")).alias("header"), F.struct(
        F.col("total").alias("totalCount"), F.struct(rows.alias("item")).alias("items")).alias("body")).alias("response"))
    other = F.struct(F.struct(F.struct(F.lit("INFO-000").alias("code")).alias("result"), F.col("total").alias("totalCnt"), F.transform(
        rows, lambda r: F.struct(r.tm.alias("OCCRRNC_DE"), r.stnNm.alias("LKNTS_NM"))).alias("row")).alias("section"))
    landed = landed.select("conv_id", F.concat(F.lit("day "), F.col("conv_id").cast("string")).alias("request_date"),
                           F.when(F.col("conv_id") % 2 == 0, F.to_json(first)).otherwise(F.to_json(other)).alias("body"))
    out = []
    for service, odd in ((READING_SERVICE, 0), (outbreak_service("section"), 1)):
        keys = ("conv_id", "request_date")
        pages = parse_responses(landed.where(F.col("conv_id") % 2 == odd), service, request_cols=keys)
        fields = T.StructType([T.StructField(service.date_field, T.StringType()), T.StructField(service.marked[0], T.StringType())])
        flat = flatten_responses(pages, service, fields, keys)
        state = page_completeness(pages, ok_codes=service.ok_codes, request_cols=keys).select("conv_id", "complete")
        out.append(flat.join(state, "conv_id").select("conv_id", F.col(service.date_field).alias("date"), F.col(service.marked[0]).alias("text"), "complete"))
    return out[0].unionByName(out[1])


# q32 -------------------------------------------------------------------------
def q32_rejects(spark, d):
    """Events with bad rows planted among them, written once: the counts of each check come
    with the write, and agree with the rows set aside."""
    e = read_table(spark, d, "events")
    i = F.col("event_id")
    e = e.select(i, F.when(i % 97 == 0, F.substring("props", 1, 3)).otherwise(F.col("props")).alias("doc"),
                 F.when(i % 89 == 1, F.lit("2024-13-45")).when(i % 89 == 2, F.lit("no_data")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"),
                 F.when(i % 83 == 2, F.lit("x")).when(i % 83 == 3, F.lit(None)).otherwise(F.col("value").cast("string")).alias("number"), "event_type")
    checks = {"document": bad_document("doc"), "date": bad_date("date", "%Y-%m-%d", "%Y%m%d"), "number": bad_number("number"),
              "category": left_out("event_type", EVENT_TYPES[:3])}
    path = scratch_folder(spark, "q32") + "/rows"
    rows, seen = measured(e, checks)
    rows.write.parquet(path)
    bad = rejected(spark.read.schema(rows.schema).parquet(path), checks)
    kinds = spark.createDataFrame([(k, v) for k, v in seen.get.items()], "kind string, n long")
    aside = bad.select(F.explode("reasons").alias("kind"), "event_id").groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.min("event_id").alias("first_id"))
    return kinds.join(aside, "kind", "left")


QUERIES = {
    "q01_envelope_unwrap": q01_envelope_unwrap,
    "q02_date_normalize": q02_date_normalize,
    "q03_page_flatten": q03_page_flatten,
    "q04_station_enrich": q04_station_enrich,
    "q05_active_candidates": q05_active_candidates,
    "q06_place_lookup": q06_place_lookup,
    "q07_nearest_l1": q07_nearest_l1,
    "q08_pivot_sum": q08_pivot_sum,
    "q09_panel": q09_panel,
    "q10_missing_keys": q10_missing_keys,
    "q11_trim_join": q11_trim_join,
    "q12_range_extract": q12_range_extract,
    "q13_high_water": q13_high_water,
    "q14_target_filter": q14_target_filter,
    "q15_iqr_filter": q15_iqr_filter,
    "q16_replicate": q16_replicate,
    "q17_binarize": q17_binarize,
    "q18_undersample": q18_undersample,
    "q19_split": q19_split,
    "q20_standardize": q20_standardize,
    "q21_gbt_score": q21_gbt_score,
    "q22_auc": q22_auc,
    "q23_class_report": q23_class_report,
    "q24_year_rollover": q24_year_rollover,
    "q25_json_records": q25_json_records,
    "q26_gap_report": q26_gap_report,
    "q27_incremental_panel": q27_incremental_panel,
    "q28_nearest_clustered": q28_nearest_clustered,
    "q29_iqr_selected": q29_iqr_selected,
    "q30_place_lookup_indexed": q30_place_lookup_indexed,
    "q31_response_pages": q31_response_pages,
    "q32_rejects": q32_rejects,
}

flagship = q09_panel


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB dialect) over the same tables.
# ---------------------------------------------------------------------------
def _gaz_values() -> str:
    def lit(v):
        return "NULL" if v is None else repr(float(v))
    return ", ".join(f"({o}, '{w}', '{n}', CAST({lit(la)} AS DOUBLE), CAST({lit(ln)} AS DOUBLE))"
                     for o, w, n, la, ln in part_gazetteer())


def _pivot_cols(types, src="cents"):
    return ", ".join(f"CAST(COALESCE(SUM(CASE WHEN event_type = '{t}' THEN {src} END), 0) AS BIGINT) AS {t}"
                     for t in types)


_EV = ("SELECT CAST(ts AS DATE) AS day, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents "
       "FROM events WHERE event_type NOT IN ('no_data', 'nodata')")

_HASH_DOC = "md5('42|' || CAST(doc_id AS VARCHAR))"
_HASH_LINE = "md5('42|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR))"


def _targets_sql():
    parts = [f"SELECT '{t}' AS target, CAST(SUM(CASE WHEN l_returnflag = '{t[0]}' AND l_linestatus = '{t[1]}' "
             f"THEN l_quantity END) AS BIGINT) AS total FROM lineitem" for t in _flag_status_targets()]
    return f"SELECT target, total FROM ({' UNION ALL '.join(parts)}) WHERE total > {TARGET_THRESHOLD}"


def _report_sql():
    m = []
    for c in (0, 1):
        m.append(f"CASE WHEN pp{c} > 0 THEN CAST(tp{c} AS DOUBLE) / pp{c} ELSE 0.0 END AS pr{c}")
        m.append(f"CASE WHEN sp{c} > 0 THEN CAST(tp{c} AS DOUBLE) / sp{c} ELSE 0.0 END AS rc{c}")
    f1 = [f"CASE WHEN pr{c} + rc{c} > 0 THEN 2.0 * pr{c} * rc{c} / (pr{c} + rc{c}) ELSE 0.0 END AS f{c}"
          for c in (0, 1)]
    return f"""
WITH d AS (SELECT quality AS y, CAST(n_chars > {REPORT_THRESHOLD} AS INTEGER) AS p
           FROM documents JOIN labels USING (doc_id)),
t AS (SELECT count(*) AS n, sum(CASE WHEN y = p THEN 1 ELSE 0 END) AS hit,
             sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS tp0, sum(CASE WHEN p = 0 THEN 1 ELSE 0 END) AS pp0,
             sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS sp0,
             sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp1, sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS pp1,
             sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS sp1 FROM d),
m AS (SELECT *, {", ".join(m)} FROM t),
g AS (SELECT *, {", ".join(f1)} FROM m)
SELECT '0' AS class, round(pr0, 6) AS precision, round(rc0, 6) AS recall, round(f0, 6) AS f1, CAST(sp0 AS BIGINT) AS support FROM g
UNION ALL SELECT '1', round(pr1, 6), round(rc1, 6), round(f1, 6), CAST(sp1 AS BIGINT) FROM g
UNION ALL SELECT 'accuracy', NULL, NULL, round(CAST(hit AS DOUBLE) / n, 6), CAST(n AS BIGINT) FROM g
UNION ALL SELECT 'macro avg', round((pr0 + pr1) / 2.0, 6), round((rc0 + rc1) / 2.0, 6), round((f0 + f1) / 2.0, 6),
                 CAST(n AS BIGINT) FROM g
UNION ALL SELECT 'weighted avg', round((pr0 * sp0 + pr1 * sp1) / (sp0 + sp1), 6),
                 round((rc0 * sp0 + rc1 * sp1) / (sp0 + sp1), 6), round((f0 * sp0 + f1 * sp1) / (sp0 + sp1), 6),
                 CAST(n AS BIGINT) FROM g
"""


ORACLE_SQL = {
    "q01_envelope_unwrap": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, ts FROM events",
    "q02_date_normalize": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d_text, "
                          "CAST(o_orderdate AS DATE) AS newdate FROM orders",
    "q03_page_flatten": """
SELECT conv_id, turn, text FROM conversations WHERE role = 'user' AND length(text) > 200
UNION ALL
SELECT k.conv_id, CAST(NULL AS BIGINT) AS turn, 'no_data' AS text
FROM (SELECT DISTINCT conv_id FROM conversations) k
WHERE NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = k.conv_id AND c.role = 'user' AND length(c.text) > 200)
""",
    "q04_station_enrich": """
SELECT s.s_suppkey, s.s_name, s.s_nationkey, m.n_name, m.n_regionkey, CAST(NULL AS VARCHAR) AS station
FROM supplier s LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) m ON s.s_nationkey = m.n_nationkey
""",
    "q05_active_candidates": """
WITH k AS (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier
           WHERE s_nationkey IN (SELECT c_nationkey FROM customer) GROUP BY s_nationkey)
SELECT s.s_nationkey, s.s_suppkey, s.s_name, s.s_acctbal, n.n_name
FROM k JOIN supplier s ON s.s_suppkey = k.s_suppkey LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
""",
    "q06_place_lookup": f"""
WITH g(ord, wide, narrow, lat, lng) AS (VALUES {_gaz_values()}),
m AS (SELECT p.p_partkey, g.wide, g.narrow, g.lat, g.lng,
             row_number() OVER (PARTITION BY p.p_partkey ORDER BY g.ord) AS rn
      FROM part p JOIN g ON contains(p.p_name, g.wide) AND contains(p.p_name, g.narrow))
SELECT p.p_partkey, p.p_name, m.wide, m.narrow, m.lat, m.lng
FROM part p LEFT JOIN m ON m.p_partkey = p.p_partkey AND m.rn = 1
WHERE p.p_name IS NOT NULL
""",
    "q07_nearest_l1": """
SELECT c_custkey, s_suppkey, round(distance, 4) AS distance FROM (
  SELECT c.c_custkey, s.s_suppkey,
         abs(c.c_acctbal - s.s_acctbal) + 100 * abs(c.c_nationkey - s.s_nationkey) AS distance,
         row_number() OVER (PARTITION BY c.c_custkey
                            ORDER BY abs(c.c_acctbal - s.s_acctbal) + 100 * abs(c.c_nationkey - s.s_nationkey),
                                     s.s_suppkey) AS rn
  FROM customer c CROSS JOIN supplier s
  WHERE c.c_acctbal IS NOT NULL AND c.c_nationkey IS NOT NULL
    AND s.s_acctbal IS NOT NULL AND s.s_nationkey IS NOT NULL) x
WHERE rn = 1
""",
    "q08_pivot_sum": f"WITH e AS ({_EV}) SELECT day, user_id, {_pivot_cols(EVENT_TYPES)} FROM e GROUP BY day, user_id",
    "q09_panel": f"""
WITH e AS ({_EV}),
v AS (SELECT day, user_id, count(*) AS n_views, CAST(sum(cents) AS BIGINT) AS view_cents
      FROM e WHERE event_type = 'view' GROUP BY day, user_id),
p AS (SELECT day, user_id, {_pivot_cols([t for t in EVENT_TYPES if t != 'view'])}
      FROM e WHERE event_type <> 'view' GROUP BY day, user_id)
SELECT v.day, v.user_id, v.n_views, v.view_cents, p.click, p.error, p.purchase, p.signup,
       c.c_nationkey, c.c_mktsegment
FROM v LEFT JOIN p ON v.day = p.day AND v.user_id = p.user_id
LEFT JOIN customer c ON c.c_custkey = v.user_id
""",
    "q10_missing_keys": """
SELECT DISTINCT o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""",
    "q11_trim_join": r"""
WITH l AS (SELECT p_partkey,
                  regexp_replace(repeat(' ', p_size % 3) || p_brand || repeat(chr(9), p_size % 2),
                                 '^\s+|\s+$', '', 'g') AS brand FROM part),
r AS (SELECT regexp_replace(' ' || p_brand || '  ', '^\s+|\s+$', '', 'g') AS brand,
             count(*) AS n_parts, CAST(sum(p_size) AS BIGINT) AS sum_size FROM part GROUP BY p_brand)
SELECT l.brand, l.p_partkey, r.n_parts, r.sum_size FROM l JOIN r ON l.brand = r.brand
""",
    "q12_range_extract": f"""
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts > TIMESTAMP '{RANGE_LO}' AND ts < TIMESTAMP '{RANGE_HI}'
ORDER BY event_id DESC, ts DESC
""",
    "q13_high_water": """
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts,
       COALESCE(max(CAST(ts AS DATE)) + 1, DATE '2024-01-01') AS next_day,
       max(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS max_k
FROM events GROUP BY user_id
""",
    "q14_target_filter": _targets_sql(),
    "q15_iqr_filter": """
WITH b AS (SELECT event_id, TRY_CAST(value AS DOUBLE) AS value,
                  value * TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS vk FROM events),
b0 AS (SELECT * FROM b WHERE value IS NOT NULL AND vk IS NOT NULL),
q1 AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS c FROM b0),
b1 AS (SELECT b0.* FROM b0, q1 WHERE value >= a - 1.5 * (c - a) AND value <= c + 1.5 * (c - a)),
q2 AS (SELECT quantile_cont(vk, 0.25) AS a, quantile_cont(vk, 0.75) AS c FROM b1),
b2 AS (SELECT b1.* FROM b1, q2 WHERE vk >= a - 1.5 * (c - a) AND vk <= c + 1.5 * (c - a))
SELECT event_id, value, vk FROM b2
""",
    "q16_replicate": """
SELECT l_orderkey, l_linenumber, CAST(unnest(range(1, greatest(COALESCE(l_linenumber, 0), 1) + 1)) AS INTEGER) AS copy
FROM lineitem
""",
    "q17_binarize": """
WITH y AS (SELECT event_id, COALESCE(CAST(floor(value / 10) AS INTEGER) - 1, 0) AS y FROM events)
SELECT event_id, y, CASE WHEN y > 0 THEN 1 ELSE y END AS label FROM y
""",
    "q18_undersample": f"""
WITH d AS (SELECT doc_id, toxic, n_chars FROM documents JOIN labels USING (doc_id) WHERE toxic IN (0, 1)),
c AS (SELECT toxic, count(*) AS n FROM d GROUP BY toxic),
m AS (SELECT CASE WHEN count(*) = 2 THEN min(n) ELSE 0 END AS m FROM c),
r AS (SELECT d.*, row_number() OVER (PARTITION BY toxic ORDER BY {_HASH_DOC}, doc_id) AS rn FROM d)
SELECT doc_id, toxic, n_chars FROM r, m WHERE r.rn <= m.m
""",
    "q19_split": f"""
WITH d AS (SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)),
c AS (SELECT quality, count(*) AS n FROM d GROUP BY quality),
r AS (SELECT d.*, row_number() OVER (PARTITION BY quality ORDER BY {_HASH_DOC}, doc_id) AS rn FROM d)
SELECT r.doc_id, r.quality, CASE WHEN r.rn <= c.n - ceil(c.n * CAST(0.2 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
FROM r JOIN c ON r.quality IS NOT DISTINCT FROM c.quality
""",
    "q20_standardize": f"""
WITH d AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, l_discount FROM lineitem),
c AS (SELECT l_returnflag, count(*) AS n FROM d GROUP BY l_returnflag),
r AS (SELECT d.*, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_HASH_LINE}, l_orderkey, l_linenumber) AS rn
      FROM d),
s AS (SELECT r.*, CASE WHEN r.rn <= c.n - ceil(c.n * CAST(0.2 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
      FROM r JOIN c ON r.l_returnflag IS NOT DISTINCT FROM c.l_returnflag),
f AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp,
             stddev_samp(l_extendedprice) AS sp, avg(l_discount) AS md, stddev_samp(l_discount) AS sd
      FROM s WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split, round((l_quantity - mq) / sq, 4) AS l_quantity_z,
       round((l_extendedprice - mp) / sp, 4) AS l_extendedprice_z, round((l_discount - md) / sd, 4) AS l_discount_z
FROM s, f
""",
    "q22_auc": """
WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS s, quality AS y FROM documents JOIN labels USING (doc_id)
           WHERE n_chars IS NOT NULL AND quality IS NOT NULL),
g AS (SELECT s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg
      FROM d GROUP BY s),
c AS (SELECT pos, neg, COALESCE(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g)
SELECT 'quality' AS target,
       round(CAST(sum(pos * (below + 0.5 * neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc
FROM c
""",
    "q23_class_report": _report_sql(),
    "q24_year_rollover": """
WITH y AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity,
                  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
SELECT year, count(*) AS n_rows, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(sum(cents) AS BIGINT) AS sum_cents
FROM y WHERE year < (SELECT max(year) FROM y) GROUP BY year
""",
    "q25_json_records": """
SELECT n_nationkey, CAST(to_json(struct_pack(n_nationkey := n_nationkey, n_name := n_name, r_name := r_name)) AS VARCHAR) AS json
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""",
    "q26_gap_report": """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
b AS (SELECT min(day) AS lo, max(day) AS hi FROM d),
s AS (SELECT u.user_id, CAST(g.day AS DATE) AS day
      FROM (SELECT DISTINCT user_id FROM d) u, b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS g(day))
SELECT user_id, day FROM s
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.user_id IS NOT DISTINCT FROM s.user_id AND d.day = s.day)
""",
    "q27_incremental_panel": """
SELECT CAST(ts AS DATE) AS day, user_id,
       CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS n_views,
       CAST(sum(CASE WHEN event_type = 'view' THEN CAST(round(value * 100) AS BIGINT) END) AS BIGINT) AS view_cents,
       CAST(coalesce(sum(CASE WHEN event_type = 'click' THEN CAST(round(value * 100) AS BIGINT) END), 0) AS BIGINT) AS click,
       CAST(coalesce(sum(CASE WHEN event_type = 'error' THEN CAST(round(value * 100) AS BIGINT) END), 0) AS BIGINT) AS error,
       CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END), 0) AS BIGINT) AS purchase,
       CAST(coalesce(sum(CASE WHEN event_type = 'signup' THEN CAST(round(value * 100) AS BIGINT) END), 0) AS BIGINT) AS signup
FROM events GROUP BY 1, 2 HAVING count(*) FILTER (WHERE event_type = 'view') > 0
""",
    "q28_nearest_clustered": """
WITH p AS (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS cents, p_size, (p_partkey % 2) * 1000000000 AS far FROM part),
c AS (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS balance, c_nationkey, (c_custkey % 2) * 1000000000 AS far FROM customer),
pp AS (SELECT p_partkey, cents + far AS x, p_size * 10 - cents + far AS y FROM p),
cc AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN balance * 1000 ELSE balance END + far AS x, c_nationkey * 1000 - balance + far AS y FROM c),
j AS (SELECT c_custkey, p_partkey, abs(cc.x - pp.x) + abs(cc.y - pp.y) AS dist FROM cc CROSS JOIN pp)
SELECT c_custkey, arg_min(p_partkey, (dist, p_partkey)) AS p_partkey, CAST(min(dist) AS DOUBLE) AS distance FROM j GROUP BY c_custkey
""",
    "q29_iqr_selected": """
WITH t0 AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(7.5 AS DOUBLE) AS fixed, l_quantity, l_discount FROM lineitem),
b0 AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM t0),
t1 AS (SELECT t0.* FROM t0, b0 WHERE l_extendedprice BETWEEN q1 - 0.3 * (q3 - q1) AND q3 + 0.3 * (q3 - q1)),
b1 AS (SELECT quantile_cont(fixed, 0.25) AS q1, quantile_cont(fixed, 0.75) AS q3 FROM t1),
t2 AS (SELECT t1.* FROM t1, b1 WHERE fixed BETWEEN q1 - 0.3 * (q3 - q1) AND q3 + 0.3 * (q3 - q1)),
b2 AS (SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3 FROM t2),
t3 AS (SELECT t2.* FROM t2, b2 WHERE l_quantity BETWEEN q1 - 0.3 * (q3 - q1) AND q3 + 0.3 * (q3 - q1)),
b3 AS (SELECT quantile_cont(l_discount, 0.25) AS q1, quantile_cont(l_discount, 0.75) AS q3 FROM t3),
t4 AS (SELECT t3.* FROM t3, b3 WHERE l_discount BETWEEN q1 - 0.3 * (q3 - q1) AND q3 + 0.3 * (q3 - q1))
SELECT * FROM t4
""",
    "q30_place_lookup_indexed": """
WITH g AS (SELECT item_id, split_part(text, ' ', 1) AS wide, split_part(text, ' ', 3) AS narrow FROM benchmark WHERE text IS NOT NULL),
h AS (SELECT doc_id, min(item_id) AS ord FROM documents JOIN g ON contains(documents.text, g.wide) AND contains(documents.text, g.narrow) GROUP BY doc_id)
SELECT d.doc_id, g.wide, g.narrow, CAST(g.item_id AS DOUBLE) AS lat, CASE WHEN g.item_id IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS lng
FROM documents d LEFT JOIN h USING (doc_id) LEFT JOIN g ON g.item_id = h.ord WHERE d.text IS NOT NULL
""",
    "q31_response_pages": """
WITH l AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rn FROM conversations
           WHERE role = 'user' AND length(text) > 200),
t AS (SELECT k.conv_id, count(l.conv_id) AS total FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN l USING (conv_id) GROUP BY 1)
SELECT l.conv_id, CAST(l.turn AS VARCHAR) AS date, l.text, NOT (l.conv_id % 7 = 3 AND t.total > 3) AS complete
FROM l JOIN t USING (conv_id) WHERE NOT (l.conv_id % 7 = 3 AND l.rn >= 3)
UNION ALL
SELECT conv_id, 'day ' || CAST(conv_id AS VARCHAR), 'no_data', true FROM t WHERE total = 0
""",
    "q32_rejects": """
WITH e AS (SELECT event_id, event_type, event_id % 97 = 0 AS document, event_id % 89 = 1 AS date, event_id % 83 = 2 AS number,
                  event_type NOT IN ('click', 'error', 'purchase') AS category FROM events),
k AS (SELECT 'rows' AS kind, count(*) AS n, CAST(NULL AS BIGINT) AS n_rows, CAST(NULL AS BIGINT) AS first_id FROM e
UNION ALL SELECT 'document', count(*), count(*), min(event_id) FROM e WHERE document
UNION ALL SELECT 'date', count(*), count(*), min(event_id) FROM e WHERE date
UNION ALL SELECT 'number', count(*), count(*), min(event_id) FROM e WHERE number
UNION ALL SELECT 'category', count(*), count(*), min(event_id) FROM e WHERE category)
SELECT kind, n, CASE WHEN n_rows = 0 THEN NULL ELSE n_rows END AS n_rows, first_id FROM k
""",
}
