import datetime as dt

from pyspark.sql import functions as F

from stationlink.operators import marks, panel


def test_clean_and_pivot(spark):
    rows = [("2024-01-01", "s1", "결핵병", "3"), ("2024-01-01", "s1", "결핵병", "2"), ("2024-01-01", "s1", "추백리", "x"),
            ("2024-01-01", "s2", "no_data", "1"), ("2024-01-02", "s1", "nodata", None), ("2024-01-02", "s1", "추백리", "4"),
            ("2024-01-02", "s2", "other", "9"), ("2024-01-03", "s3", None, "1")]
    df = spark.createDataFrame(rows, "d string, st string, cat string, cnt string")
    clean = panel.clean_categories(df, "cat", "cnt")
    assert clean.count() == 4
    pv = panel.pivot_sum(clean, ["d", "st"], "cat", "cnt", ["결핵병", "추백리"])
    got = {(r.d, r.st): (r["결핵병"], r["추백리"]) for r in pv.collect()}
    assert got == {("2024-01-01", "s1"): (5, 0), ("2024-01-02", "s1"): (0, 4), ("2024-01-02", "s2"): (0, 0)}


def test_panel_join_keeps_nulls_and_single_keys(spark):
    rd = spark.createDataFrame([("d1", "s1", 1.0), ("d2", "s1", 2.0)], "d string, st string, t double")
    pv = spark.createDataFrame([("d1", "s1", 5)], "d string, st string, n int")
    out = panel.panel_join(rd, pv, ["d", "st"])
    assert out.columns == ["d", "st", "t", "n"]
    assert sorted((r.d, r.n) for r in out.collect()) == [("d1", 5), ("d2", None)]


def test_missing_keys_and_trim(spark):
    a = spark.createDataFrame([(" s1 ", 1), ("s2\t", 2), ("s3", 3)], "st string, v int")
    b = spark.createDataFrame([("s1",), ("s3  ",)], "st string")
    miss = panel.missing_keys(panel.trim_keys(a, ["st"]), panel.trim_keys(b, ["st"]), ["st"])
    assert [r.st for r in miss.collect()] == ["s2"]


def test_enrich_left(spark):
    df = spark.createDataFrame([("s1",), ("s9",)], "st string")
    m = spark.createDataFrame([("s1", 37.0)], "name string, lat double")
    got = sorted((r.st, r.lat) for r in panel.enrich_left(df, m, "st", "name", ["lat"]).collect())
    assert got == [("s1", 37.0), ("s9", None)]


def test_high_water_and_json_mark(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 3, 10)), (1, dt.datetime(2024, 1, 5)), (2, None)],
                               "u int, ts timestamp")
    hw = {r.u: r.next_day for r in marks.high_water(ev, "ts", by=["u"]).collect()}
    assert hw == {1: dt.date(2024, 1, 6), 2: dt.date(2024, 1, 1)}
    js = spark.createDataFrame([('{"OCCRRNC_DE": "20240107"}',), ('{"OCCRRNC_DE": "2024-01-09"}',), ("{}",)], "j string")
    r = marks.json_high_water(js, "j", "$.OCCRRNC_DE").first()
    assert r.last_day == dt.date(2024, 1, 9) and r.next_day == dt.date(2024, 1, 10)
    empty = marks.json_high_water(js.where("false"), "j", "$.OCCRRNC_DE").first()
    assert empty.next_day == dt.date(2024, 1, 1)


def test_date_span_spine_gaps(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 4)), (2, dt.datetime(2024, 1, 2))],
                               "u int, ts timestamp")
    sp = marks.date_span(ev, "ts").first()
    assert sp.first == dt.datetime(2024, 1, 1) and sp.last == dt.datetime(2024, 1, 4)
    gaps = sorted((r.u, r.day.day) for r in marks.gap_report(ev, "u", "ts").collect())
    assert gaps == [(1, 2), (1, 3), (2, 1), (2, 3), (2, 4)]
    keys = spark.createDataFrame([(1,)], "u int")
    assert marks.day_spine(keys, "2024-01-05", "2024-01-01").count() == 0
    assert marks.day_spine(keys, "2024-01-01", "2024-01-03").count() == 3
