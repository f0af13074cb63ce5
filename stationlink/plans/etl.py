"""The daily batch: envelopes -> typed rows -> stations -> places -> nearest station ->
category pivot -> panel of readings with one column per category.

Every step is a library operator; this module only wires them together with the
configuration (``TableConf``) and writes the outputs. Fixes over the source system
(see the README): every outbreak keeps its own nearest station (not one per day), null
coordinates never win, the tie goes to the first station, the panel has every key once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_date, strip_ws, to_number, typed_null
from ..operators import geo, panel
from ..schemas import (ENVELOPE_SCHEMA, FEATURES, FULL_READING_SCHEMA, OUTBREAK_CONF, OUTBREAK_SCHEMA, READING_CONF,
                       TARGETS, TableConf)
from ..sources.envelope import unwrap_envelope
from ..sources.sinks import write_run
from ..sources.stations import active_stations, read_stations



def load_json_config(path: str) -> dict:
    """Driver-side config (table config, gazetteer): small files by nature."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def add_date_and_key(df: DataFrame, conf: TableConf, alt_formats: tuple = ()) -> DataFrame:
    """``newdate`` from the configured column and format (other formats tried next, the
    source writes some sentinels in another one), and the station key column as a typed
    null when it is derived from another column."""
    d = parse_date(F.col(conf.date_col), conf.date_format)
    for fmt in alt_formats:
        d = F.coalesce(d, parse_date(F.col(conf.date_col), fmt))
    out = df.withColumn("newdate", d)
    if conf.essential_col != conf.reference_col:
        out = out.withColumn(conf.essential_col, typed_null("string"))
    return out


def prepare_readings(readings: DataFrame, stations: DataFrame, conf: TableConf = READING_CONF,
                     features=FEATURES) -> DataFrame:
    """Readings with ``newdate``, trimmed station name, numeric features and the station
    coordinates (left join: a reading of an unknown station keeps nulls)."""
    r = add_date_and_key(readings, conf, alt_formats=("%Y%m%d",))
    r = r.withColumn(conf.essential_col, strip_ws(F.col(conf.essential_col)))
    r = r.select(*[to_number(F.col(c)).alias(c) if c in features else F.col(c) for c in r.columns])
    # one row a name, or a name that the master holds twice would double its readings
    st = active_stations(stations).groupBy("name").agg(F.min(F.struct("lat", "lng")).alias("at")).select(
        "name", F.col("at.lat").alias("obs_lat"), F.col("at.lng").alias("obs_lng"))
    return panel.enrich_left(r, st, conf.essential_col, "name", ["obs_lat", "obs_lng"])


def station_candidates(readings: DataFrame, stations: DataFrame, key: str = "stnNm") -> DataFrame:
    """Stations that occur in the readings, one row each (``name, lat, lng``)."""
    st = active_stations(stations).withColumn("name", strip_ws(F.col("name")))
    return geo.active_candidates(st, readings, "name", fact_key=key, order_col="lat")


def place_outbreaks(outbreaks: DataFrame, candidates: DataFrame, gazetteer,
                    conf: TableConf = OUTBREAK_CONF) -> DataFrame:
    """Outbreaks with coordinates from the gazetteer and the nearest station as the key
    column; rows without an address are dropped (they cannot be placed). Each distinct
    address is placed once and joined back, so rows need no id and repeated ones stay."""
    o = add_date_and_key(outbreaks, conf)
    ref = conf.reference_col
    placed = geo.place_lookup(o.select(ref).distinct(), ref, gazetteer, id_col=ref)
    # tie between equidistant stations: the first by name (file order is not kept by a
    # distributed read, a name order is the same on every run)
    near = geo.nearest_l1(placed, candidates, ref, "lat", "lng", "lat", "lng", "name", ["name"])
    near = near.select(ref, F.col("name").alias(conf.essential_col), F.col("distance").alias("station_distance"))
    return o.drop(conf.essential_col).join(placed.join(near, ref, "left"), ref)


def outbreak_pivot(placed: DataFrame, targets=TARGETS, key: str = "stnNm") -> DataFrame:
    """Sum of head counts per (day, station), one column per disease, 0 in empty cells."""
    clean = panel.clean_categories(placed, "LKNTS_NM", "OCCRRNC_LVSTCKCNT")
    return panel.pivot_sum(clean, ["newdate", key], "LKNTS_NM", "OCCRRNC_LVSTCKCNT", list(targets), fill=0)


def build_panel(readings: DataFrame, outbreaks: DataFrame, stations: DataFrame, gazetteer,
                targets=TARGETS) -> DataFrame:
    """The whole batch as one lazy plan (plus the small actions of the nearest search)."""
    r = prepare_readings(readings, stations)
    cands = station_candidates(r, stations)
    placed = place_outbreaks(outbreaks, cands, gazetteer)
    return panel.panel_join(r, outbreak_pivot(placed, targets), ["newdate", "stnNm"])


def run_etl(spark: SparkSession, reading_src: str, outbreak_src: str, station_csv: str, gazetteer: dict,
            out_dir: str, run_id: str, targets=TARGETS) -> DataFrame:
    """ACTION. Read landed envelope files, write the raw copies first, build the panel,
    refuse an empty one, write it under ``out_dir/panel/run_id=<run_id>`` (a rerun of the
    same run replaces it). Returns the panel as written (read back)."""
    env = {name: spark.read.schema(ENVELOPE_SCHEMA).json(src)
           for name, src in (("temperature", reading_src), ("cattle", outbreak_src))}
    def landed(name: str, schema) -> DataFrame:
        """The envelope rows as they came, all fields, written before anything is parsed."""
        write_run(env[name], f"{out_dir}/{name}_org", run_id)
        raw = spark.read.parquet(f"{out_dir}/{name}_org").where(F.col("run_id") == run_id).drop("run_id")
        return unwrap_envelope(raw, schema)

    raw_r, raw_o = landed("temperature", FULL_READING_SCHEMA), landed("cattle", OUTBREAK_SCHEMA)
    stations = read_stations(spark, station_csv)
    entries = geo.gazetteer_from_nested(spark, gazetteer)
    pan = build_panel(raw_r, raw_o, stations, entries, targets)
    write_run(pan, f"{out_dir}/panel", run_id)
    # checked as written: the panel is computed once
    out = spark.read.schema(pan.withColumn("run_id", F.lit(run_id)).schema).parquet(f"{out_dir}/panel").where(F.col("run_id") == run_id)
    if out.isEmpty():
        raise RuntimeError("the panel is empty")
    return out
