import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationlink.functions import (binarize, json_field, l1_distance, not_sentinel, parse_date, strftime_to_java,
                                   strip_ws, to_number, typed_null)


def test_strftime_to_java():
    assert strftime_to_java("%Y%m%d") == "yyyyMMdd"
    assert strftime_to_java("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    with pytest.raises(ValueError):
        strftime_to_java("%b %d")


def test_parse_date_permissive_and_strict(spark):
    df = spark.createDataFrame([("20240105",), ("2024-01-05",), ("bad",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_date("s", "%Y%m%d")).collect()]
    assert got == [dt.date(2024, 1, 5), None, None, None]
    ts = df.select(parse_date("s", "%Y-%m-%d %H").alias("t")).schema["t"].dataType.simpleString()
    assert ts.startswith("timestamp")
    with pytest.raises(Exception):
        df.select(parse_date("s", "%Y%m%d", strict=True)).collect()


def test_to_number_never_raises(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("  7 ",)], "s string")
    assert [r[0] for r in df.select(to_number("s")).collect()] == [1.5, None, None, 7.0]
    assert [r[0] for r in df.select(to_number("s", "int")).collect()] == [None, None, None, 7]


def test_strip_ws_and_sentinel(spark):
    df = spark.createDataFrame([(" a\t",), ("no_data",), ("nodata",), (None,)], "s string")
    assert [r[0] for r in df.select(strip_ws("s")).collect()] == ["a", "no_data", "nodata", None]
    assert [r[0] for r in df.select(not_sentinel("s")).collect()] == [True, False, False, None]


def test_binarize_l1_json_typed_null(spark):
    df = spark.createDataFrame([(3, 1.0, 2.0, '{"k": 5}'), (0, -1.0, 0.5, "{}"), (-2, 0.0, 0.0, "oops")],
                               "y int, a double, b double, j string")
    rows = df.select(binarize("y").alias("l"), l1_distance("a", "b", F.lit(0.0), F.lit(0.0), 1.0, 2.0).alias("d"),
                     json_field("j", "$.k", "int").alias("k"), typed_null("int").alias("n")).collect()
    assert [r.l for r in rows] == [1, 0, -2]
    assert [r.d for r in rows] == [5.0, 2.0, 0.0]
    assert [r.k for r in rows] == [5, None, None]
    assert all(r.n is None for r in rows)
