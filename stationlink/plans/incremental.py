"""The daily batch, incremental: newly landed envelope files go into the store by day, and
only the days they touch are built again.

    reading files  --foreachBatch-->  readings (day, batch), station names
    outbreak files --foreachBatch-->  outbreaks (day, batch), sums per address and category, addresses
    touched days   -->  enriched, placed, panel  (live, complete years moved to the archive)

An outbreak touches its own day. A station that reports for the first time, or an address
met for the first time, changes where outbreaks belong: the addresses whose station
changes are found by comparing both assignments, and the days of their outbreaks are
touched as well. So any sequence of runs leaves the tables that one run over all files
leaves. A changed station master or gazetteer takes effect on days built afterwards;
``rebuild=True`` builds all days.

A reading that is delivered again replaces the one before: of the readings of a day and
station the last one (execute_date, then id) counts, so the panel has every key once.
Readings without a day or a station name have no key and all stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import geo, panel
from ..schemas import (ENVELOPE_SCHEMA, FEATURES, FULL_READING_SCHEMA, OUTBREAK_CONF, OUTBREAK_SCHEMA, READING_CONF,
                       TARGETS)
from ..sources.envelope import unwrap_envelope
from ..sources.stations import read_stations
from ..streaming.daystore import BATCH, DAY, DayStore, on_days
from .etl import add_date_and_key, place_outbreaks, prepare_readings, station_candidates

KEY, ADDRESS, CATEGORY, HEADS = READING_CONF.essential_col, OUTBREAK_CONF.reference_col, "LKNTS_NM", "OCCRRNC_LVSTCKCNT"
_ORIGIN = [T.StructField("id", T.LongType()), T.StructField("execute_date", T.TimestampType())]
_AT = [T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())]
PLACE = T.StructType([T.StructField(ADDRESS, T.StringType()), *_AT, T.StructField(KEY, T.StringType()), T.StructField("station_distance", T.DoubleType())])

BATCHES = {
    "readings": T.StructType([*FULL_READING_SCHEMA.fields, *_ORIGIN]),
    "station_names": T.StructType([T.StructField(KEY, T.StringType())]),
    "outbreaks": T.StructType([*OUTBREAK_SCHEMA.fields, *_ORIGIN]),
    "outbreak_sums": T.StructType([T.StructField(ADDRESS, T.StringType()), T.StructField(CATEGORY, T.StringType()), T.StructField("heads", T.LongType())]),
    "addresses": T.StructType([T.StructField(ADDRESS, T.StringType())]),
}


def _built(targets) -> dict[str, T.StructType]:
    enriched = [T.StructField(f.name, T.DoubleType() if f.name in FEATURES else f.dataType) for f in FULL_READING_SCHEMA.fields]
    enriched += [*_ORIGIN, T.StructField("newdate", T.DateType()), T.StructField("obs_lat", T.DoubleType()), T.StructField("obs_lng", T.DoubleType())]
    return {
        "enriched": T.StructType(enriched),
        "placed": T.StructType([*OUTBREAK_SCHEMA.fields, *_ORIGIN, T.StructField("newdate", T.DateType()), *PLACE.fields[1:]]),
        "panel": T.StructType([*enriched, *[T.StructField(t, T.LongType()) for t in targets]]),
    }


def open_store(spark: SparkSession, out_dir: str, targets=TARGETS) -> DayStore:
    return DayStore(spark, out_dir, BATCHES, _built(targets))


def land(spark: SparkSession, src: str, checkpoint: str, each: Callable[[DataFrame, int], None], max_files: int | None = None,
         schema: T.StructType = ENVELOPE_SCHEMA, fmt: str = "json") -> int:
    """ACTION. Give the rows of the files of ``src`` that no run before has read to ``each``
    (rows, batch number). A batch that failed is given again under the same number.
    Returns the number of batches."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    n = [0]

    def batch(df: DataFrame, number: int) -> None:
        n[0] += 1
        each(df, number)

    reader.load(src).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return n[0]


def last_of_key(readings: DataFrame) -> DataFrame:
    """One reading of each (day, station): the last one delivered. Those without a key all stay."""
    key = F.col(DAY).isNotNull() & F.col(KEY).isNotNull()
    last = Window.partitionBy(DAY, KEY).orderBy(F.desc_nulls_last("execute_date"), F.desc_nulls_last("id"), F.desc("_all"))
    keyed = readings.where(key).withColumn("_all", F.to_json(F.struct(*FULL_READING_SCHEMA.fieldNames()))).withColumn("_n", F.row_number().over(last))
    return keyed.where("_n = 1").drop("_n", "_all").unionByName(readings.where(~key))


def _add_readings(store: DayStore):
    def each(env: DataFrame, number: int) -> None:
        raw = _raw_copy(store, "temperature_org", env, number)
        rows = add_date_and_key(unwrap_envelope(raw, FULL_READING_SCHEMA, keep=("id", "execute_date")), READING_CONF, alt_formats=("%Y%m%d",))
        rows = panel.trim_keys(rows, [KEY])
        store.add("readings", rows, number, F.col("newdate"))
        names = store.rows("readings").where(F.col(BATCH) == number).select(KEY).where(F.col(KEY).isNotNull()).distinct()
        store.add("station_names", names, number, F.lit(None))
    return each


def _add_outbreaks(store: DayStore):
    def each(env: DataFrame, number: int) -> None:
        raw = _raw_copy(store, "cattle_org", env, number)
        rows = add_date_and_key(unwrap_envelope(raw, OUTBREAK_SCHEMA, keep=("id", "execute_date")), OUTBREAK_CONF)
        store.add("outbreaks", rows, number, F.col("newdate"))
        rows = store.rows("outbreaks").where(F.col(BATCH) == number)
        sums = panel.clean_categories(rows, CATEGORY, HEADS).where(F.col(ADDRESS).isNotNull()).groupBy(DAY, ADDRESS, CATEGORY).agg(
            F.sum(HEADS).cast("long").alias("heads"))
        store.add("outbreak_sums", sums, number)
        store.add("addresses", rows.select(ADDRESS).where(F.col(ADDRESS).isNotNull()).distinct(), number, F.lit(None))
    return each


def _raw_copy(store: DayStore, name: str, env: DataFrame, number: int) -> DataFrame:
    """The rows as they came, written before anything is parsed, and read back."""
    store._write(env.withColumn(BATCH, F.lit(number).cast("long")), [BATCH], name)
    return store._read(T.StructType([*ENVELOPE_SCHEMA.fields, T.StructField(BATCH, T.LongType())]), name).where(F.col(BATCH) == number).drop(BATCH)


def _places(store: DayStore, stations: DataFrame, gazetteer: DataFrame, version: str, rebuild: bool) -> tuple[DataFrame, list, str]:
    """The station of every address (written as a version of its own), the days of outbreaks
    at addresses whose station is another than in the version of the last commit, and a
    mark of the candidates."""
    names = store.rows("station_names").select(KEY).distinct()
    candidates = station_candidates(names, stations)
    mark = candidates.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("name", "lat", "lng")).alias("h")).first()
    mark = f"{mark.n}:{mark.h}"
    seen = store.committed().get("addresses", (-1, None))
    before = _version(store)
    todo = store.rows("addresses").select(ADDRESS).distinct()
    if not rebuild and before is not None and seen[1] == mark:
        # the same candidates: only addresses not met before have to be placed
        todo = todo.join(before.select(ADDRESS), ADDRESS, "left_anti")
    fresh = place_outbreaks(todo.withColumns({OUTBREAK_CONF.date_col: F.lit(None).cast("string"), KEY: F.lit(None).cast("string")}), candidates, gazetteer)
    fresh = fresh.select(*PLACE.fieldNames())
    if before is not None:
        fresh = fresh.unionByName(before.join(fresh.select(ADDRESS), ADDRESS, "left_anti"))
    store._write(fresh.withColumn("version", F.lit(version)), ["version"], "places")
    now = _version(store, version)
    days: list = []
    if before is not None:
        moved = now.join(before.select(ADDRESS, F.col(KEY).alias("_old")), ADDRESS).where(~F.col(KEY).eqNullSafe(F.col("_old"))).select(ADDRESS)
        days = store.days(store.rows("outbreaks").join(moved, ADDRESS, "left_semi"))
    return now, days, mark


def _version(store: DayStore, version: str | None = None) -> DataFrame | None:
    """A version of the places; without a name that of the last commit."""
    version = version or (store.committed().get("places") or (None, None))[1]
    if version is None:
        return None
    return store._read(T.StructType([*PLACE.fields, T.StructField("version", T.StringType())]), "places").where(F.col("version") == version).drop("version")


def update_panel(spark: SparkSession, reading_src: str, outbreak_src: str, station_csv: str, gazetteer: dict, out_dir: str, run_id: str,
                 targets=TARGETS, max_files: int | None = None, rebuild: bool = False, archive: bool = False) -> DataFrame:
    """ACTION. One run: load what has landed since the run before, build the touched days of
    ``enriched``, ``placed`` and ``panel`` under ``out_dir`` again, and commit. Returns the
    whole panel (lazy). A run that died is made good by the next one, under any ``run_id``.
    With ``archive``, complete years move to the archive."""
    store = open_store(spark, out_dir, targets)
    for name, src, each in (("temperature", reading_src, _add_readings), ("cattle", outbreak_src, _add_outbreaks)):
        try:
            land(spark, src, f"{store.root}/_progress/{name}", each(store), max_files)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise                               # a source that has not landed anything yet has no folder
    stations = read_stations(spark, station_csv)
    version = f"{run_id}-{store.next_commit()}"     # a run that is repeated reads what it wrote before
    places, moved, mark = _places(store, stations, geo.gazetteer_from_nested(spark, gazetteer), version, rebuild)
    days = list(dict.fromkeys([*store.pending("readings"), *store.pending("outbreaks"), *moved]))
    if rebuild:
        days = list(dict.fromkeys([*store.days(store.rows("readings")), *store.days(store.rows("outbreaks"))]))
    if days:
        build_days(store, days, stations, places, targets)
    last = {t: (store.last_batch(t), None) for t in ("readings", "outbreaks", "addresses")}
    store.commit({**last, "addresses": (last["addresses"][0], mark), "places": (0, version)})
    if archive:
        store.archive("panel")
    return store.whole("panel").drop(DAY)


def build_days(store: DayStore, days: list, stations: DataFrame, places: DataFrame, targets=TARGETS) -> None:
    """ACTION. Build the tables of these days from the rows of all batches."""
    readings = last_of_key(store.rows("readings", days))
    enriched = prepare_readings(readings, stations)
    store.replace_days("enriched", enriched)
    outbreaks = add_date_and_key(store.rows("outbreaks", days), OUTBREAK_CONF).drop(KEY).where(F.col(ADDRESS).isNotNull())
    store.replace_days("placed", outbreaks.join(places, ADDRESS, "left"))
    # every batch has its own sums: added up per station, however often a day was touched
    sums = store.rows("outbreak_sums", days).join(places.select(ADDRESS, KEY), ADDRESS)
    pivot = panel.pivot_sum(sums.withColumn("newdate", F.col(DAY)), ["newdate", KEY], CATEGORY, "heads", list(targets))
    store.replace_days("panel", panel.panel_join(store.live("enriched").where(on_days(days)), pivot, ["newdate", KEY]))


def categories_left_out(store: DayStore, targets=TARGETS) -> DataFrame:
    """(category, outbreak heads) that the panel has no column for."""
    return store.rows("outbreak_sums").where(~F.col(CATEGORY).isin(*targets)).groupBy(CATEGORY).agg(F.sum("heads").alias("heads"))


def missing_panel_keys(store: DayStore) -> DataFrame:
    """(newdate, station) of placed outbreaks that have no reading: their heads are in no panel row."""
    placed = store.whole("placed").where(F.col("newdate").isNotNull() & F.col(KEY).isNotNull())
    return panel.missing_keys(placed, store.whole("panel"), ["newdate", KEY])

