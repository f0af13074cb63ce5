import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlink.schemas import ENVELOPE_SCHEMA, OUTBREAK_SCHEMA
from stationlink.sources.envelope import check_range_args, extract_range, unwrap_envelope
from stationlink.sources.pages import flatten_pages, page_completeness, rows_or_sentinel
from stationlink.sources.sinks import archive_years, complete_years, file_high_water, json_records, write_run
from stationlink.sources.stations import active_stations, read_stations


def test_station_csv_with_bom(spark, tmp):
    path = os.path.join(tmp, "stations.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("지점,지점명,위도,경도,종료일\n")
        f.write("1,서울,37.57,126.97,\n")
        f.write("2,폐쇄,35.0,128.0,2010-05-01\n")
        f.write("3,좌표없음,,,\n")
        f.write("4,서울,37.50,127.00,\n")
    st = read_stations(spark, path)
    assert st.columns == ["name", "lat", "lng", "end_date"]
    rows = sorted(active_stations(st).collect(), key=lambda r: (r.name, r.lat or 0))
    assert [r.name for r in rows] == ["서울", "서울", "좌표없음"]
    assert rows[2].lat is None
    closed = st.where("name = '폐쇄'").first()
    assert closed.end_date == dt.date(2010, 5, 1)


def test_envelope_unwrap(spark):
    rows = [(1, json.dumps({"LKNTS_NM": "결핵병", "OCCRRNC_DE": "20240105", "OCCRRNC_LVSTCKCNT": "3"}), dt.datetime(2024, 1, 20)),
            (2, "{not json", dt.datetime(2024, 1, 20)),
            (3, json.dumps({"LKNTS_NM": "no_data", "OCCRRNC_DE": "20240106"}), dt.datetime(2024, 1, 20))]
    env = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    out = unwrap_envelope(env, OUTBREAK_SCHEMA).orderBy("OCCRRNC_DE").collect()
    assert len(out) == 3
    good = [r for r in out if r.LKNTS_NM == "결핵병"][0]
    assert good.OCCRRNC_LVSTCKCNT == "3" and good.FARM_NM is None
    assert sum(1 for r in out if r.LKNTS_NM is None) == 1  # malformed row kept as nulls


def test_range_args_and_open_interval(spark):
    with pytest.raises(ValueError):
        check_range_args("nope", "20240101000000", "20240102000000", ["cattle"])
    with pytest.raises(ValueError):
        check_range_args("cattle", "20240102000000", "20240101000000", ["cattle"])
    with pytest.raises(ValueError):
        check_range_args("cattle", "2024-01-01", "20240101000000", ["cattle"])
    lo, hi = check_range_args("cattle", "20240101000000", "20240103000000", ["cattle"])
    env = spark.createDataFrame([(1, "{}", dt.datetime(2024, 1, 1)), (2, "{}", dt.datetime(2024, 1, 2)),
                                 (3, "{}", dt.datetime(2024, 1, 3)), (4, "{}", dt.datetime(2024, 1, 2, 5))],
                                ENVELOPE_SCHEMA).withColumn("execute_date", F.col("execute_date").cast("timestamp_ntz"))
    got = [r.id for r in extract_range(env, lo, hi).collect()]
    assert got == [4, 2]  # both ends exclusive, newest id first


PAGE_SCHEMA = T.StructType([
    T.StructField("request_date", T.StringType()), T.StructField("page", T.IntegerType()),
    T.StructField("code", T.StringType()), T.StructField("totalCnt", T.IntegerType()),
    T.StructField("row", T.ArrayType(T.StructType([T.StructField("LKNTS_NM", T.StringType()),
                                                   T.StructField("OCCRRNC_DE", T.StringType())])))])


def test_flatten_pages_and_completeness(spark):
    pages = spark.createDataFrame([
        ("20240101", 1, "INFO-000", 3, [("a", "20240101"), ("b", "20240101")]),
        ("20240101", 2, "INFO-000", 3, [("c", "20240101")]),
        ("20240102", 1, "INFO-000", 0, None),
        ("20240103", 1, "INFO-000", 5, [("d", "20240103")]),  # partial: 1 of 5 landed
        ("20240104", 1, "ERROR-300", 0, None),
    ], PAGE_SCHEMA)
    flat = flatten_pages(pages, sentinel={"LKNTS_NM": "no_data"})
    got = sorted((r.request_date, r.LKNTS_NM) for r in flat.collect())
    assert got == [("20240101", "a"), ("20240101", "b"), ("20240101", "c"), ("20240102", "no_data"), ("20240103", "d")]
    comp = {r.request_date: r for r in page_completeness(pages).collect()}
    assert comp["20240101"].complete and comp["20240102"].complete
    assert not comp["20240103"].complete and not comp["20240104"].complete


def test_rows_or_sentinel(spark):
    keys = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    rows = spark.createDataFrame([(1, 10, "x")], "k int, t int, v string")
    got = sorted(tuple(r) for r in rows_or_sentinel(keys, rows, ["k"], {"v": "no_data"}).collect())
    assert got == [(1, 10, "x"), (2, None, "no_data")]


def test_write_run_is_idempotent(spark, tmp):
    path = os.path.join(tmp, "out")
    df = spark.range(5)
    write_run(df, path, "20240101000000")
    write_run(df, path, "20240101000000")  # rerun of the same run replaces it
    write_run(spark.range(2), path, "20240102000000")
    back = spark.read.parquet(path)
    assert back.count() == 7
    assert back.where("run_id = '20240101000000'").count() == 5


def test_year_archive(spark, tmp):
    df = spark.createDataFrame([(dt.date(2022, 5, 1), 1), (dt.date(2023, 12, 31), 2), (dt.date(2024, 1, 1), 3)],
                               "d date, v int")
    done, live = complete_years(df, "d")
    assert sorted(r.v for r in done.collect()) == [1, 2] and [r.v for r in live.collect()] == [3]
    path = os.path.join(tmp, "arch")
    live2 = archive_years(df, "d", path)
    assert live2.count() == 1
    assert sorted(r.year for r in spark.read.parquet(path).select("year").distinct().collect()) == [2022, 2023]
    assert spark.read.parquet(path).where("year = 2022").count() == 1  # partition pruning path


def test_json_records_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 2, 3, 4, 5))], "id int, s string, t timestamp")
    txt = json_records(df, ["id", "s", "t"]).first()[0]
    assert json.loads(txt) == {"id": 1, "s": None, "t": "2024-01-02T03:04:05.000"}


def test_file_high_water(spark, tmp):
    d = os.path.join(tmp, "landed")
    os.makedirs(d)
    assert file_high_water(spark, os.path.join(tmp, "landed"), "20240101000000").first().mark == "20240101000000" \
        if os.listdir(d) else True
    for stamp in ("20240105120000", "20240107000000"):
        with open(os.path.join(d, f"cattle_{stamp}.json"), "w") as f:
            f.write("{}\n")
    assert file_high_water(spark, d, "20240101000000").first().mark == "20240107000000"


def test_read_pages_from_landed_files(spark, tmp):
    from stationlink.sources.pages import read_pages
    row = T.StructType([T.StructField("LKNTS_NM", T.StringType()), T.StructField("OCCRRNC_DE", T.StringType())])
    d = os.path.join(tmp, "pages")
    os.makedirs(d)
    with open(os.path.join(d, "p1.json"), "w") as f:
        f.write(json.dumps({"request_date": "20240101", "code": "INFO-000", "totalCnt": 1,
                            "row": [{"LKNTS_NM": "a", "OCCRRNC_DE": "20240101"}]}) + "\n")
    with open(os.path.join(d, "p2.json"), "w") as f:
        f.write(json.dumps({"request_date": "20240102", "code": "INFO-000", "totalCnt": 0, "row": []}) + "\n")
    pages = read_pages(spark, d, row)
    got = sorted((r.request_date, r.LKNTS_NM) for r in flatten_pages(pages, sentinel={"LKNTS_NM": "no_data"}).collect())
    assert got == [("20240101", "a"), ("20240102", "no_data")]


def test_tune_for_cluster_keeps_launch_settings(spark):
    from stationlink.session import CLUSTER_CONF, tune_for_cluster
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        applied = tune_for_cluster(spark, {"spark.sql.shuffle.partitions": "64"})
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
        assert applied["spark.sql.files.maxPartitionBytes"] == CLUSTER_CONF["spark.sql.files.maxPartitionBytes"]
        # set when the session was built: kept
        assert "spark.sql.session.timeZone" not in applied
    finally:
        for k in CLUSTER_CONF:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_both_response_shapes(spark):
    from stationlink.sources.pages import READING_SERVICE, outbreak_service, parse_responses, flatten_responses
    weather = lambda code, total, item: json.dumps({"response": {"header": {"resultCode": code}, "body": {"totalCount": total, "items": {"item": item}}}})
    raw = [("20240101", weather("00", 2, [{"stnNm": "a", "tm": "2024-01-01", "avgTa": 1.5}, {"stnNm": "b", "avgTa": "x"}])),
           ("20240102", weather("00", 0, [])), ("20240102", weather("00", 0, None)), ("20240103", weather("99", 5, [{"stnNm": "lost"}])),
           ("20240104", weather("00", "1", {"stnNm": "alone", "tm": "2024-01-04"})), ("20240105", "not json"), ("20240106", None)]
    df = spark.createDataFrame(raw, "request_date string, body string")
    fields = T.StructType([T.StructField("stnNm", T.StringType()), T.StructField("tm", T.StringType()), T.StructField("avgTa", T.DoubleType())])
    pages = parse_responses(df, READING_SERVICE)
    got = sorted((tuple(r) for r in flatten_responses(pages, READING_SERVICE, fields).collect()), key=str)
    assert got == [("20240101", "a", "2024-01-01", 1.5), ("20240101", "b", None, None), ("20240102", "no_data", "20240102", None),
                   ("20240104", "alone", "2024-01-04", None)]
    state = {r.request_date: (r.complete, r.bad_pages) for r in page_completeness(pages, ok_codes=READING_SERVICE.ok_codes).collect()}
    assert state["20240101"] == (True, 0) and state["20240104"] == (True, 0) and state["20240103"] == (False, 1)
    cattle = outbreak_service("Grid_1")
    raw = [("20240101", json.dumps({"Grid_1": {"result": {"code": "INFO-000"}, "totalCnt": 0, "row": []}}))]
    one = flatten_responses(parse_responses(spark.createDataFrame(raw, "request_date string, body string"), cattle), cattle,
                            T.StructType([T.StructField("LKNTS_NM", T.StringType()), T.StructField("OCCRRNC_DE", T.StringType())])).collect()
    assert [tuple(r) for r in one] == [("20240101", "no_data", "20240101")]


def test_rejects_are_counted_and_kept(spark, tmp):
    from stationlink.sources.rejects import bad_date, bad_document, bad_number, measured, rejected
    rows = [(1, "{}", "20240101", "1"), (2, "{", "x", "y"), (3, None, None, None), (4, "{}", "nodata", "nan"), (5, "[1]", "2024-01-01", " 7 ")]
    df = spark.createDataFrame(rows, "id int, doc string, d string, n string")
    checks = {"doc": bad_document("doc"), "date": bad_date("d", "%Y%m%d", "%Y-%m-%d"), "number": bad_number("n")}
    out, seen = measured(df, checks)
    out.write.parquet(os.path.join(tmp, "rows"))
    assert seen.get == {"rows": 5, "doc": 1, "date": 1, "number": 1}
    assert [(r.id, r.reasons) for r in rejected(df, checks).collect()] == [(2, ["doc", "date", "number"])]
