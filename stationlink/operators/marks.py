"""Incremental state: high-water marks, date span, day spine and gap report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import BASE_DATE


def high_water(df: DataFrame, ts_col: str, by: list | None = None, base: str = BASE_DATE,
               extra: list | None = None) -> DataFrame:
    """Latest event day (per ``by`` group when given) and the next day to fetch; the
    next day is ``base`` when a group has no parsable date. ``extra`` aggregates ride
    along in the same single aggregation."""
    last = F.max(F.to_date(F.col(ts_col)))
    agg = [F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"),
           F.coalesce(F.date_add(last, 1), F.to_date(F.lit(base))).alias("next_day")]
    return df.groupBy(*(by or [])).agg(*agg, *(extra or []))


def json_high_water(df: DataFrame, json_col: str, path: str, fmt: str = "yyyyMMdd",
                    by: list | None = None, base: str = BASE_DATE) -> DataFrame:
    """Mark from a date field inside JSON text: latest value, next day, default ``base``.
    Accepts ``fmt`` and ISO dates (the source writes both)."""
    raw = F.get_json_object(F.col(json_col), path)
    d = F.coalesce(F.try_to_date(raw, fmt), F.try_to_date(raw, "yyyy-MM-dd"))
    return (df.groupBy(*(by or []))
              .agg(F.max(d).alias("last_day"))
              .withColumn("next_day", F.coalesce(F.date_add("last_day", 1), F.to_date(F.lit(base)))))


def date_span(df: DataFrame, ts_col: str) -> DataFrame:
    """First and last value in one aggregate (no sort)."""
    return df.agg(F.min(ts_col).alias("first"), F.max(ts_col).alias("last"))


def day_spine(keys: DataFrame, lo, hi, day_col: str = "day") -> DataFrame:
    """Every key with every day from ``lo`` to ``hi`` (columns or literals). The spine is
    generated per key row by ``sequence`` (no cross join); ``lo > hi`` gives nothing."""
    lo, hi = F.to_date(lo if not isinstance(lo, str) else F.lit(lo)), F.to_date(hi if not isinstance(hi, str) else F.lit(hi))
    seq = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 DAY")))
    return keys.select("*", F.explode(seq).alias(day_col))


def gap_report(df: DataFrame, key: str, ts_col: str, day_col: str = "day") -> DataFrame:
    """(key, day) pairs without a row, over the table's whole day range. The range is
    one small aggregate; the holes are those between a key's neighbouring days and at its
    two ends, so the work follows the days present and the days missing. A null key is a
    key like any other; rows with a null day only name their key."""
    days = df.select(F.col(key), F.to_date(F.col(ts_col)).alias(day_col))
    # ACTION: both ends in one aggregate (one row back), used as literals
    lo, hi = days.agg(F.min(day_col), F.max(day_col)).first()
    if lo is None:
        return days.select(key, day_col).limit(0)
    # a key's window holds its distinct days only, however many rows it has
    w = Window.partitionBy(key).orderBy(F.col(day_col).asc_nulls_first())
    near = days.distinct().select(key, F.col(day_col).alias("_d"), F.lag(day_col).over(w).alias("_before"),
                                  F.lead(day_col).over(w).alias("_after"))

    def hole(first, last):
        none = F.array().cast("array<date>")
        return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).otherwise(none)

    before = hole(F.coalesce(F.date_add("_before", 1), F.lit(lo)), F.date_sub("_d", 1))
    tail = hole(F.when(F.col("_after").isNull(), F.coalesce(F.date_add("_d", 1), F.lit(lo))), F.lit(hi))
    return near.select(key, F.explode(F.concat(before, tail)).alias(day_col))
