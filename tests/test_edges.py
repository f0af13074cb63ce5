"""Odd inputs: collinear and non-finite points, constant columns, null keys and dates, late
rows, empty reports."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationlink.operators import features, geo, marks, model
from stationlink.sources import sinks


@pytest.mark.parametrize("n", [2, 3, 20, 36, 97])
def test_nearest_on_a_line_finds_the_last_candidate(spark, n):
    pts = [(i, i / (n - 1), 0.0) for i in range(n)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    got = geo.nearest_l1(df, df.withColumnRenamed("id", "c"), "id", "x", "y", "x", "y", "c", ["c"]).collect()
    assert all(r.id == r.c and r.distance == 0 for r in got) and len(got) == n


def test_nearest_skips_candidates_that_are_not_finite(spark):
    cands = spark.createDataFrame([(1, 0.0, 0.0), (2, float("nan"), 0.0), (3, float("inf"), 1.0), (4, 5.0, 5.0)], "c int, x double, y double")
    q = spark.createDataFrame([(1, 0.1, 0.0), (2, 4.0, 4.0)], "id int, x double, y double")
    got = {r.id: r.c for r in geo.nearest_l1(q, cands, "id", "x", "y", "x", "y", "c", ["c"]).collect()}
    assert got == {1: 1, 2: 4}


def test_order_statistics_of_a_constant_column(spark):
    df = spark.range(50).select(F.lit(3.0).alias("v"))
    assert features._order_statistics(df, "v", [0, 24, 49], 3.0, 3.0) == {0: 3.0, 24: 3.0, 49: 3.0}


def test_target_threshold_is_compared_before_the_cast(spark):
    df = spark.createDataFrame([(300.6, 300.0)], "a double, b double")
    assert [(r.target, r.total) for r in features.select_targets(df, ["a", "b"], 300).collect()] == [("a", 300)]


def test_gap_report_knows_a_null_keys_days(spark):
    rows = [(None, dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 2)), ("a", dt.date(2024, 1, 2))]
    df = spark.createDataFrame(rows, "k string, d date")
    assert [tuple(r) for r in marks.gap_report(df, "k", "d").collect()] == [("a", dt.date(2024, 1, 1))]


def test_class_report_of_nothing(spark):
    df = spark.createDataFrame([], "y int, prediction int")
    rows = {r["class"]: r for r in model.class_report(df, "y").collect()}
    assert rows["accuracy"].f1 is None and rows["0"].support == 0


def test_auc_counts_beyond_a_long_and_nan_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.5), (0, 0.1), (1, float("nan"))], "y int, score double")
    one = model.auc_frame(df, "y").first().auc
    many = model.auc_frame(df, "y", bucket_rows=1).first().auc
    assert one == many == pytest.approx(5 / 6)


def test_archive_keeps_undated_rows_live_and_late_rows(spark, tmp):
    day = lambda y: dt.date(y, 5, 1)
    first = spark.createDataFrame([(day(2022), i) for i in range(5)] + [(day(2024), 9), (None, 10)], "d date, i int")
    live = sinks.archive_years(first, "d", tmp + "/a", run_id="1")
    assert {r.i for r in live.collect()} == {9, 10}
    late = spark.createDataFrame([(day(2022), 50), (day(2024), 51)], "d date, i int")
    for _ in range(2):  # a rerun replaces its own rows
        sinks.archive_years(late, "d", tmp + "/a", run_id="2")
    assert sorted(r.i for r in spark.read.parquet(tmp + "/a").collect()) == [0, 1, 2, 3, 4, 50]


def test_file_mark_without_a_folder_and_on_a_run(spark, tmp):
    assert sinks.file_high_water(spark, tmp + "/none", "20200101").first().mark == "20200101"
    sinks.write_run(spark.range(1), tmp + "/t", "20240203040506")
    assert sinks.file_high_water(spark, tmp + "/t", "20200101").first().mark == "20240203040506"


def test_gap_report_against_all_days(spark):
    """Repeated days, null keys and days, a key with null days only, full and single days."""
    r = random.Random(4)
    day0 = dt.date(2024, 2, 20)
    rows = [(k, day0 + dt.timedelta(d)) for k in ("a", "b", None, "c") for d in r.choices(range(20), k=9)]
    rows += [("full", day0 + dt.timedelta(d)) for d in range(20)] + [("a", None), ("none", None), ("one", day0)]
    got = [tuple(x) for x in marks.gap_report(spark.createDataFrame(rows, "k string, ts date"), "k", "ts").collect()]
    days = [d for _, d in rows if d]
    span = [min(days) + dt.timedelta(i) for i in range((max(days) - min(days)).days + 1)]
    want = [(k, d) for k in {k for k, _ in rows} for d in span if (k, d) not in rows]
    assert len(got) == len(want) and set(got) == set(want)
