import json
import os

from pyspark.sql import functions as F

from stationlink.plans import etl, training
from stationlink.schemas import OUTBREAK_SCHEMA, READING_SCHEMA, TARGETS

GAZ = {"강원": {"강릉": [37.75, 128.87], "고성": ["nodata", "nodata"]},
       "경기": {"수원": [37.26, 127.01], "이천": [37.27, 127.43]}}


def _stations(tmp):
    path = os.path.join(tmp, "st.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("지점,지점명,위도,경도,종료일\n1,강릉,37.75,128.89,\n2,수원,37.27,126.98,\n3,이천,37.26,127.48,\n"
                "4,폐쇄,37.0,127.0,2001-01-01\n5,서울,37.57,126.97,\n")
    return path


def _readings(spark):
    rows = []
    for day in ("2024-01-01", "2024-01-02"):
        for st in ("강릉", " 수원 ", "이천"):
            rows.append(("1", st, day, "1.5", "-3.0", "6.0", "55"))
    rows.append(("9", "서울", "20240102", "x", "0", "1", "50"))  # other date format, bad feature
    return spark.createDataFrame(rows, READING_SCHEMA)


def _outbreaks(spark):
    def rec(**kw):
        base = {f.name: None for f in OUTBREAK_SCHEMA.fields}
        base.update(kw)
        return tuple(base[f.name] for f in OUTBREAK_SCHEMA.fields)
    rows = [rec(ROW_NUM="1", LKNTS_NM=TARGETS[1], OCCRRNC_DE="20240101", FARM_LOCPLC="강원도 강릉시 어딘가", OCCRRNC_LVSTCKCNT="3"),
            rec(ROW_NUM="2", LKNTS_NM=TARGETS[1], OCCRRNC_DE="20240101", FARM_LOCPLC="경기도 이천시", OCCRRNC_LVSTCKCNT="2"),
            rec(ROW_NUM="3", LKNTS_NM=TARGETS[8], OCCRRNC_DE="20240101", FARM_LOCPLC="경기도 이천시", OCCRRNC_LVSTCKCNT="4"),
            rec(ROW_NUM="4", LKNTS_NM=TARGETS[8], OCCRRNC_DE="20240102", FARM_LOCPLC="경기 수원", OCCRRNC_LVSTCKCNT="x"),
            rec(ROW_NUM="5", LKNTS_NM="no_data", OCCRRNC_DE="20240102"),
            rec(ROW_NUM="6", LKNTS_NM=TARGETS[1], OCCRRNC_DE="20240102", FARM_LOCPLC=None, OCCRRNC_LVSTCKCNT="7"),
            rec(ROW_NUM="7", LKNTS_NM=TARGETS[1], OCCRRNC_DE="20240102", FARM_LOCPLC="강원 고성군", OCCRRNC_LVSTCKCNT="1")]
    return spark.createDataFrame(rows, OUTBREAK_SCHEMA)


def test_build_panel(spark, tmp):
    from stationlink.sources.stations import read_stations
    from stationlink.operators import geo
    st = read_stations(spark, _stations(tmp))
    pan = etl.build_panel(_readings(spark), _outbreaks(spark), st, geo.gazetteer_from_nested(spark, GAZ))
    cols = pan.columns
    assert cols.count("newdate") == 1 and cols.count("stnNm") == 1
    rows = {(str(r.newdate), r.stnNm): r for r in pan.collect()}
    assert len(rows) == 7
    # two outbreaks on one day at different places keep their own stations
    assert rows[("2024-01-01", "강릉")][TARGETS[1]] == 3
    assert rows[("2024-01-01", "이천")][TARGETS[1]] == 2 and rows[("2024-01-01", "이천")][TARGETS[8]] == 4
    # a day without outbreaks keeps nulls; the padded station name was trimmed and joined
    assert rows[("2024-01-01", "수원")][TARGETS[1]] is None
    assert rows[("2024-01-02", "서울")].avgTa is None and rows[("2024-01-02", "서울")].obs_lat == 37.57


def test_place_outbreaks_rules(spark, tmp):
    from stationlink.sources.stations import read_stations
    from stationlink.operators import geo
    st = read_stations(spark, _stations(tmp))
    r = etl.prepare_readings(_readings(spark), st)
    cands = etl.station_candidates(r, st)
    assert sorted(x.name for x in cands.collect()) == ["강릉", "서울", "수원", "이천"]
    placed = {x.ROW_NUM: x for x in etl.place_outbreaks(_outbreaks(spark), cands, geo.gazetteer_from_nested(spark, GAZ)).collect()}
    assert "6" not in placed                        # no address: dropped before the lookup
    assert placed["7"].lat is None and placed["7"].stnNm is None   # sentinel coordinates: no station
    assert placed["2"].stnNm == "이천" and placed["4"].stnNm == "수원"


def test_run_etl_and_training(spark, tmp):
    rsrc, osrc = os.path.join(tmp, "r"), os.path.join(tmp, "o")
    os.makedirs(rsrc)
    os.makedirs(osrc)
    with open(os.path.join(rsrc, "temperature_20240103000000.json"), "w", encoding="utf-8") as f:
        for i, r in enumerate(_readings(spark).collect()):
            f.write(json.dumps({"id": i, "json_data": json.dumps(r.asDict(), ensure_ascii=False),
                                "execute_date": "2024-01-17T00:00:00"}, ensure_ascii=False) + "\n")
    with open(os.path.join(osrc, "cattle_20240103000000.json"), "w", encoding="utf-8") as f:
        for i, r in enumerate(_outbreaks(spark).collect()):
            f.write(json.dumps({"id": i, "json_data": json.dumps(r.asDict(), ensure_ascii=False),
                                "execute_date": "2024-01-17T00:00:00"}, ensure_ascii=False) + "\n")
    out = os.path.join(tmp, "store")
    pan = etl.run_etl(spark, rsrc, osrc, _stations(tmp), GAZ, out, "20240103000000")
    assert pan.count() == 7
    again = etl.run_etl(spark, rsrc, osrc, _stations(tmp), GAZ, out, "20240103000000")
    assert again.count() == 7 and spark.read.parquet(os.path.join(out, "cattle_org")).count() == 7
    # training: thresholds low enough for the fixture; one-class targets are skipped
    big = again.unionByName(again.withColumn("avgTa", F.col("avgTa") + 0.1)).withColumn(
        "stnNm", F.concat("stnNm", F.monotonically_increasing_id().cast("string")))
    rep = training.train_targets(big, threshold=1, params={"maxIter": 3, "maxDepth": 2},
                                 out_dir=os.path.join(tmp, "models"))
    assert rep.columns == ["target", "class", "precision", "recall", "f1", "support", "auc"]


def test_training_skips_a_bad_target(spark, tmp):
    """A target with a single positive row cannot be split; the healthy one is trained."""
    rows = [("2024-01-%02d" % (i % 28 + 1), f"s{i}", float(i % 9), float(i % 5), float(i % 7), float(i), int(i >= 30), int(i == 4)) for i in range(60)]
    df = spark.createDataFrame(rows, "newdate string, stnNm string, avgTa double, minTa double, maxTa double, avgRhm double, good int, bad int")
    skipped = {}
    rep = training.train_targets(df, targets=("good", "bad"), threshold=0, params={"maxIter": 2, "maxDepth": 2}, out_dir=tmp, skipped=skipped)
    assert {r.target for r in rep.collect()} == {"good"} and rep.where("auc > 0.9").count() == 5
    assert list(skipped) == ["bad"] and "no row of class" in skipped["bad"]
    assert spark.read.parquet(os.path.join(tmp, "bad_skipped")).first().target == "bad"
