import json
import os
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlink.operators import model
from stationlink.schemas import ENVELOPE_SCHEMA, OUTBREAK_SCHEMA
from stationlink.sources.envelope import unwrap_envelope
from stationlink.streaming import incremental_load


def test_class_report_matches_hand_count(spark):
    ys = [0, 0, 0, 1, 1, 1, 1, 0]
    ps = [0, 1, 0, 1, 1, 0, 1, 0]
    df = spark.createDataFrame(list(zip(ys, ps)), "y int, p int")
    rep = {r["class"]: r for r in model.class_report(df, "y", "p").collect()}
    p0, r0 = 3 / 4, 3 / 4
    p1, r1 = 3 / 4, 3 / 4
    assert abs(rep["0"].precision - p0) < 1e-12 and abs(rep["1"].recall - r1) < 1e-12
    assert rep["accuracy"].f1 == 6 / 8 and rep["weighted avg"].support == 8
    assert abs(rep["macro avg"].f1 - (2 * p0 * r0 / (p0 + r0) + 2 * p1 * r1 / (p1 + r1)) / 2) < 1e-12


def test_auc_ties_half(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.2, 0), (0.9, 1)]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = model.auc(spark.createDataFrame(rows, "score double, y int"), "y")
    assert abs(got - want) < 1e-12


def test_auc_frame_equals_brute_force_and_evaluator(spark):
    rnd = random.Random(4)
    rows = [(float(rnd.randint(0, 40)), rnd.random() < 0.3 + 0.01 * i % 2) for i in range(700)]
    rows = [(s, int(y)) for s, y in rows] + [(None, 1), (3.0, None)]
    df = spark.createDataFrame(rows, "score double, y int")
    pos = [s for s, y in rows if y == 1 and s is not None]
    neg = [s for s, y in rows if y == 0 and s is not None]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for r in (10**9, 7, 1):   # one range, a few, one range per distinct score
        got = model.auc_frame(df, "y", bucket_rows=r).first()["auc"]
        assert abs(got - want) < 1e-12
    assert abs(model.auc(df.na.drop(), "y") - want) < 1e-12
    one_class = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, y int")
    assert model.auc_frame(one_class, "y").first()["auc"] is None


def test_gbt_fit_score_small(spark, tmp):
    rows = [(float(i), float(i % 7), 1 if i > 20 else 0, i) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, y int, id int")
    m, scored = model.fit_and_score(df, df, ["a", "b"], "y", {"maxIter": 5, "maxDepth": 2})
    assert scored.count() == 40
    assert model.auc(scored, "y") > 0.9
    model.save_model(m, os.path.join(tmp, "m"))
    model.save_report(model.class_report(scored, "y"), os.path.join(tmp, "r"))
    assert spark.read.parquet(os.path.join(tmp, "r")).count() == 5


def _land(d, name, docs):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        for i, (rec, ts) in enumerate(docs):
            f.write(json.dumps({"id": rec["ROW_NUM"], "json_data": json.dumps(rec, ensure_ascii=False),
                                "execute_date": ts}) + "\n")


def test_incremental_two_runs_equal_one(spark, tmp):
    src, out1, ck1 = [os.path.join(tmp, x) for x in ("src", "out1", "ck1")]
    os.makedirs(src)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("json_data", T.StringType()),
                           T.StructField("execute_date", T.StringType())])

    def transform(df):
        return unwrap_envelope(df, OUTBREAK_SCHEMA, keep=("id",))

    rec = lambda i, day: ({"ROW_NUM": i, "LKNTS_NM": "결핵병", "OCCRRNC_DE": day, "OCCRRNC_LVSTCKCNT": "1"},
                          "2024-01-20T00:00:00")
    _land(src, "cattle_20240101000000.json", [rec(1, "20240101"), rec(2, "20240102")])
    r1 = incremental_load(spark, src, schema, out1, ck1, transform=transform)
    _land(src, "cattle_20240102000000.json", [rec(3, "20240103")])
    r2 = incremental_load(spark, src, schema, out1, ck1, transform=transform)
    r3 = incremental_load(spark, src, schema, out1, ck1, transform=transform)  # nothing new: nothing written
    assert (r1["rows"], r2["rows"], r3["rows"]) == (2, 1, 0)
    out2, ck2 = os.path.join(tmp, "out2"), os.path.join(tmp, "ck2")
    incremental_load(spark, src, schema, out2, ck2, transform=transform)
    a = sorted(tuple(r) for r in spark.read.parquet(out1).collect())
    b = sorted(tuple(r) for r in spark.read.parquet(out2).collect())
    assert a == b and len(a) == 3
