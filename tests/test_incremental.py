"""Incremental panel: any sequence of runs leaves what one run over all files leaves."""

import datetime
import json
import os
import random

import pytest

from stationlink.operators import geo
from stationlink.plans import etl, incremental
from stationlink.schemas import FULL_READING_SCHEMA, OUTBREAK_FIELDS, OUTBREAK_SCHEMA, READING_FIELDS, TARGETS
from stationlink.sources.stations import read_stations
from stationlink.streaming.daystore import DayStore

GAZ = {"강원": {"강릉": [37.75, 128.87], "고성": ["nodata", "nodata"]},
       "경기": {"수원": [37.26, 127.01], "이천": [37.27, 127.43], "양평": [37.5, 127.49]}}
STATIONS = [("강릉", 37.75, 128.89), ("수원", 37.27, 126.98), ("이천", 37.26, 127.48), ("서울", 37.57, 126.97)]


def station_csv(tmp):
    path = os.path.join(tmp, "stations.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("지점,지점명,위도,경도,종료일\n" + "".join(f"1,{n},{a},{b},\n" for n, a, b in STATIONS))
    return path


def reading(station, day, value, at="2024-03-01T00:00:00", **more):
    return {"stnId": "1", "stnNm": station, "tm": day, "avgTa": str(value), "minTa": "0", "maxTa": "9", "avgRhm": "50", "sumRn": f"rain {value}", **more}, at


def outbreak(day, place, kind, heads):
    return {"LKNTS_NM": kind, "OCCRRNC_DE": day, "FARM_LOCPLC": place, "OCCRRNC_LVSTCKCNT": heads, "FARM_NM": "f"}, "2024-03-01T00:00:00"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        for i, (row, at) in enumerate(rows):
            text = row if isinstance(row, str) else json.dumps(row, ensure_ascii=False)
            f.write(json.dumps({"id": i, "json_data": text, "execute_date": at}, ensure_ascii=False) + "\n")


# three deliveries; a station appears in the second, a late reading and a late outbreak come in the third
READINGS = [
    [reading("강릉", "2023-12-30", 1), reading(" 수원 ", "2023-12-30", 2), reading("강릉", "2024-01-02", 3), reading("수원", "2024-01-02", "x"), ("not json", "2024-03-01T00:00:00")],
    [reading("이천", "2024-01-02", 5), reading("강릉", "20240103", 6), reading("이천", "2024-01-03", 7), reading("수원", None, 0)],
    [reading("이천", "2023-12-30", 8), reading("강릉", "2024-01-02", 9, at="2024-04-01T00:00:00"), reading("강릉", "2024-01-04", 10)],
]
OUTBREAKS = [
    [outbreak("20231230", "경기도 이천시", TARGETS[1], "3"), outbreak("20240102", "경기도 이천시", TARGETS[1], "2"), outbreak("20240102", "강원 강릉", "other disease", "5")],
    [outbreak("20240102", "경기도 수원시", TARGETS[8], "4"), outbreak("20240102", None, TARGETS[8], "6"), outbreak("20240103", "강원 고성군", TARGETS[1], "7")],
    [outbreak("20231230", "경기도 이천시", TARGETS[1], "10"), outbreak("20240103", "경기도 양평군", TARGETS[1], "1"), outbreak("20240104", "강원 강릉", "no_data", None), outbreak("bad", "강원 강릉", TARGETS[1], "2")],
]


def deliver(base, k):
    land(f"{base}/r", f"temperature_2024010{k}000000.json", READINGS[k])
    land(f"{base}/o", f"cattle_2024010{k}000000.json", OUTBREAKS[k])


def run(spark, tmp, base, out, run_id, **kw):
    return incremental.update_panel(spark, f"{base}/r", f"{base}/o", station_csv(tmp), GAZ, out, run_id, **kw)


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def once(spark, tmp_path_factory):
    """All files in one run."""
    tmp = str(tmp_path_factory.mktemp("once"))
    for k in range(3):
        deliver(f"{tmp}/in", k)
    out = f"{tmp}/out"
    return rows_of(run(spark, tmp, f"{tmp}/in", out, "20240301000000")), incremental.open_store(spark, out)


def test_three_runs_equal_one_run(spark, tmp, once):
    for k in range(3):
        deliver(f"{tmp}/in", k)
        pan = run(spark, tmp, f"{tmp}/in", f"{tmp}/out", f"2024010{k}000000")
    got = rows_of(pan)
    assert got == once[0]
    keys = [(r.newdate, r.stnNm) for r in pan.collect() if r.newdate]
    assert len(keys) == len(set(keys)) == 9
    store = incremental.open_store(spark, f"{tmp}/out")
    for t in ("enriched", "placed"):
        assert rows_of(store.whole(t)) == rows_of(once[1].whole(t))
    # the outbreak of the first run moved to the station that appeared in the second
    cell = {(str(r.newdate), r.stnNm): r for r in pan.collect()}
    assert cell[("2024-01-02", "이천")][TARGETS[1]] == 2 and cell[("2024-01-02", "수원")][TARGETS[8]] == 4
    assert cell[("2023-12-30", "이천")][TARGETS[1]] == 13 and cell[("2023-12-30", "수원")][TARGETS[1]] is None
    # delivered again: the last one counts; the whole record is carried
    assert cell[("2024-01-02", "강릉")].avgTa == 9.0 and cell[("2024-01-02", "강릉")].sumRn == "rain 9"
    assert set(READING_FIELDS) <= set(pan.columns) and len(READING_FIELDS) == 68
    # what the panel has no column or no row for
    assert [tuple(r) for r in incremental.categories_left_out(store).collect()] == [("other disease", 5)]
    assert incremental.missing_panel_keys(store).count() == 0


def test_panel_equals_the_full_batch(spark, tmp, once):
    """Without a reading delivered twice the panel is that of the whole batch."""
    flat = [(x, at) for part in READINGS for x, at in part if isinstance(x, dict)]
    flat = [x for x, at in flat if not (x["stnNm"] == "강릉" and x["tm"] == "2024-01-02" and at < "2024-04")]
    r = spark.createDataFrame([tuple(x.get(f) for f in READING_FIELDS) for x in flat], FULL_READING_SCHEMA)
    o = spark.createDataFrame([tuple(x.get(f) for f in OUTBREAK_FIELDS) for part in OUTBREAKS for x, _ in part], OUTBREAK_SCHEMA)
    want = etl.build_panel(r, o, read_stations(spark, station_csv(tmp)), geo.gazetteer_from_nested(spark, GAZ)).where("newdate IS NOT NULL")
    got = once[1].whole("panel").where("newdate IS NOT NULL").select(*want.columns)
    assert rows_of(got) == rows_of(want)


def test_only_touched_days_are_written(spark, tmp):
    deliver(f"{tmp}/in", 0)
    run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "1")
    folder = f"{tmp}/out/panel/day=2023-12-30"
    before = sorted(os.listdir(folder))
    land(f"{tmp}/in/r", "later.json", [reading("강릉", "2024-02-01", 1)])
    run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "2")
    assert sorted(os.listdir(folder)) == before and os.path.isdir(f"{tmp}/out/panel/day=2024-02-01")
    # nothing new: nothing is written
    stamp = {d: sorted(os.listdir(f"{tmp}/out/panel/{d}")) for d in os.listdir(f"{tmp}/out/panel") if d.startswith("day")}
    run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "3")
    assert {d: sorted(os.listdir(f"{tmp}/out/panel/{d}")) for d in stamp} == stamp


def test_a_run_that_died_is_made_good(spark, tmp, once, monkeypatch):
    deliver(f"{tmp}/in", 0)
    deliver(f"{tmp}/in", 1)
    with monkeypatch.context() as m:
        m.setattr(incremental, "build_days", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "1")
    deliver(f"{tmp}/in", 2)
    assert rows_of(run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "2", max_files=1)) == once[0]
    assert rows_of(run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "2", rebuild=True)) == once[0]


def test_archive_loses_and_doubles_nothing(spark, tmp, once, monkeypatch):
    for k in range(2):
        deliver(f"{tmp}/in", k)
    run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "1")
    store = incremental.open_store(spark, f"{tmp}/out")
    before = rows_of(store.whole("panel"))
    with monkeypatch.context() as m:
        m.setattr(DayStore, "drop_day", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.archive("panel")
    assert store.archived("panel").count() > 0 and rows_of(store.whole("panel")) == before
    assert store.archive("panel") == [datetime.date(2023, 12, 30)] and store.archive("panel") == []
    assert rows_of(store.whole("panel")) == before
    assert {str(d)[:4] for d in store.days(store.live("panel")) if d} == {"2024"}
    # a late row of an archived year: its day is live again until the next archive
    deliver(f"{tmp}/in", 2)
    assert rows_of(run(spark, tmp, f"{tmp}/in", f"{tmp}/out", "2", archive=True)) == once[0]
    assert store.archived("panel").count() == 3 and store.live("panel").where("year(day) = 2023").count() == 0


def test_random_deliveries(spark, tmp):
    r = random.Random(3)
    days = [f"2024-01-{d:02d}" for d in range(1, 5)]
    rows = [reading(s, d, r.randrange(9)) for s, _, _ in STATIONS for d in days]
    sick = [outbreak(r.choice(days).replace("-", ""), r.choice(["경기 수원", "경기 이천", "강원 강릉", "경기 양평"]), r.choice(TARGETS), str(r.randrange(5))) for _ in range(30)]
    r.shuffle(rows)
    for k in range(2):
        land(f"{tmp}/in/r", f"{k}.json", rows[k::2])
        land(f"{tmp}/in/o", f"{k}.json", sick[k::2])
        got = run(spark, tmp, f"{tmp}/in", f"{tmp}/out", str(k))
    assert rows_of(got) == rows_of(run(spark, tmp, f"{tmp}/in", f"{tmp}/fresh", "x"))
    assert sum(sum(x[t] or 0 for t in TARGETS) for x in got.collect()) == sum(int(x["OCCRRNC_LVSTCKCNT"]) for x, _ in sick)
