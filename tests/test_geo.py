import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlink.operators import geo
from stationlink.schemas import GAZETTEER_SCHEMA

GAZ = {
    # a region hit without a city hit must fall through to the next region
    "old": {"anvil": [1.0, 1.0], "bolt": [2.0, 2.0]},
    "cold": {"ring": [3.0, 3.0], "anvil": [4.0, 4.0]},
    "red": {"rod": ["nodata", "nodata"], "ring": [5.0, 5.0]},
}


def _brute_lookup(text, entries):
    if text is None:
        return None
    for o, w, n, la, ln in entries:
        if w in text and n in text:
            return (w, n, la, ln)
    return (None, None, None, None)


def test_gazetteer_flatten_keeps_order_and_nulls(spark):
    g = geo.gazetteer_from_nested(spark, GAZ).orderBy("ord").collect()
    assert [(r.wide, r.narrow) for r in g] == [("old", "anvil"), ("old", "bolt"), ("cold", "ring"),
                                              ("cold", "anvil"), ("red", "rod"), ("red", "ring")]
    assert g[4].lat is None and g[0].lat == 1.0


def test_place_lookup_semantics_both_strategies(spark):
    gaz = geo.gazetteer_from_nested(spark, GAZ)
    entries = [tuple(r) for r in gaz.orderBy("ord").collect()]
    texts = [(1, "cold anvil"), (2, "cold ring"), (3, "red rod"), (4, "bold ring"), (5, None), (6, "nothing here"),
             (7, "red ring old bolt")]
    df = spark.createDataFrame(texts, "id int, t string")
    lit = {r.id: (r.wide, r.narrow, r.lat, r.lng) for r in geo.place_lookup(df, "t", gaz, "id").collect()}
    join = {r.id: (r.wide, r.narrow, r.lat, r.lng) for r in geo.place_lookup(df, "t", gaz, "id", literal_max=0).collect()}
    from_list = {r.id: (r.wide, r.narrow, r.lat, r.lng) for r in geo.place_lookup(df, "t", entries, "id").collect()}
    want = {i: _brute_lookup(t, entries) for i, t in texts if t is not None}
    assert lit == want == join == from_list
    assert want[1] == ("old", "anvil", 1.0, 1.0)      # "cold" contains "old"
    assert want[2] == ("cold", "ring", 3.0, 3.0)      # "old" fits, none of its cities: next region
    assert want[3] == ("red", "rod", None, None)      # sentinel pair: null coordinates
    assert 5 not in lit                               # rows without text are dropped first


def test_substring_join_long_texts_across_pieces(spark):
    # pieces of 4 start positions: names straddle piece borders, sit at the very end, or
    # only fit in the overlap; the result must equal the literal scan over whole texts
    gaz = geo.gazetteer_from_nested(spark, GAZ)
    rnd = random.Random(3)
    words = ["old", "cold", "anvil", "bolt", "ring", "red", "rod", "xy", "z"]
    texts = [(i, "".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))) for i in range(60)]
    texts += [(100, "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzred"), (101, "zzzrodzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzred"),
              (102, "")]
    df = spark.createDataFrame(texts, "id int, t string")
    lit = {r.id: tuple(r)[2:] for r in geo.place_lookup(df, "t", gaz, "id").collect()}
    join = {r.id: tuple(r)[2:] for r in geo._substring_join_lookup(df, "t", gaz, "id", piece=4).collect()}
    assert lit == join and len(join) == len(texts)
    assert join[101][:2] == ("red", "rod")


def test_place_lookup_has_no_python_udf(spark):
    df = spark.createDataFrame([(1, "cold ring")], "id int, t string")
    plan = geo.place_lookup(df, "t", geo.gazetteer_from_nested(spark, GAZ), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _brute_nearest(qs, cs, wx, wy):
    out = {}
    for qid, qx, qy in qs:
        if qx is None or qy is None:
            out[qid] = (None, None)
            continue
        best = None
        for o, cx, cy in cs:
            if cx is None or cy is None:
                continue
            d = wx * abs(qx - cx) + wy * abs(qy - cy)
            if best is None or (d, o) < best:
                best = (d, o)
        out[qid] = (best[1], round(best[0], 6)) if best else (None, None)
    return out


def test_nearest_equals_brute_force(spark):
    rnd = random.Random(7)
    cs = [(i, round(rnd.uniform(-50, 50), 1), rnd.randint(0, 9)) for i in range(60)]
    cs += [(60, cs[0][1], cs[0][2]), (61, None, 3), (62, 5.0, None)]   # co-located twin, null coordinates
    cs += [(63, 1000.0, 100)]                                          # far outlier stretches the grid
    qs = [(i, round(rnd.uniform(-80, 80), 1), rnd.randint(-3, 12)) for i in range(300)]
    qs += [(300, None, 1), (301, 5000.0, 500), (302, cs[5][1], cs[5][2])]
    q = spark.createDataFrame(qs, "qid int, x double, y int")
    c = spark.createDataFrame(cs, "cid int, x double, y int")
    got = geo.nearest_l1(q, c, "qid", "x", "y", "x", "y", "cid", ["cid"], 1.0, 3.0)
    res = {r.qid: (r.cid, None if r.distance is None else round(r.distance, 6)) for r in got.collect()}
    assert res == _brute_nearest(qs, cs, 1.0, 3.0)
    assert len(res) == len(qs)


def test_nearest_far_queries_equal_brute_force(spark):
    # queries far outside the candidates' box on every side and corner, and a crowd of
    # 200 at one far point: searched from the clamp point, still exact
    rnd = random.Random(5)
    cs = [(i, round(rnd.uniform(0, 20), 2), round(rnd.uniform(0, 20), 2)) for i in range(120)]
    far = [(-900.0, 10.0), (900.0, 3.0), (7.0, -900.0), (11.0, 900.0), (-500.0, -600.0), (800.0, 700.0),
           (20.0, 0.0), (-0.5, 20.5)]
    qs = [(i, x, y) for i, (x, y) in enumerate(far)] + [(100 + i, 5000.0, 5000.0) for i in range(200)]
    q = spark.createDataFrame(qs, "qid int, x double, y double")
    c = spark.createDataFrame(cs, "cid int, x double, y double")
    got = geo.nearest_l1(q, c, "qid", "x", "y", "x", "y", "cid", ["cid"], 1.0, 2.0)
    res = {r.qid: (r.cid, round(r.distance, 6)) for r in got.collect()}
    assert res == _brute_nearest(qs, cs, 1.0, 2.0)


coord = st.one_of(st.none(), st.integers(-30, 30).map(float), st.sampled_from([-1e4, 1e4]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=60),
       st.lists(st.tuples(coord, coord), min_size=0, max_size=80),
       st.sampled_from([0.5, 1.0, 4.0]), st.sampled_from([1.0, 2.0]))
def test_nearest_property(spark, cands, points, per_cell, wy):
    # integer grid coordinates give many ties and repeated points; far values and nulls
    # on both sides: equals brute force with ties to the lowest candidate order
    cs = [(i, x, y) for i, (x, y) in enumerate(cands)]
    qs = [(i, x, y) for i, (x, y) in enumerate(points)]
    q = spark.createDataFrame(qs, "qid int, x double, y double")
    c = spark.createDataFrame(cs, "cid int, x double, y double")
    got = geo.nearest_l1(q, c, "qid", "x", "y", "x", "y", "cid", ["cid"], 1.0, wy, per_cell=per_cell,
                         dense_factor=2.0)
    res = {r.qid: (r.cid, None if r.distance is None else round(r.distance, 6)) for r in got.collect()}
    assert res == _brute_nearest(qs, cs, 1.0, wy)


def test_nearest_no_candidates(spark):
    q = spark.createDataFrame([(1, 1.0, 1.0)], "qid int, x double, y double")
    c = spark.createDataFrame([(1, None, None)], "cid int, x double, y double")
    r = geo.nearest_l1(q, c, "qid", "x", "y", "x", "y", "cid", ["cid"]).collect()
    assert len(r) == 1 and r[0].cid is None


def test_nearest_plan_has_no_cartesian(spark):
    q = spark.range(50).select(F.col("id").alias("qid"), (F.col("id") * 1.5).alias("x"), F.lit(0.0).alias("y"))
    c = spark.range(20).select(F.col("id").alias("cid"), (F.col("id") * 3.7).alias("x"), F.lit(1.0).alias("y"))
    out = geo.nearest_l1(q, c, "qid", "x", "y", "x", "y", "cid", ["cid"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert out.count() == 50


def test_active_candidates_lowest_key(spark):
    st = spark.createDataFrame([("A", 3, 1.0), ("A", 1, 2.0), ("B", 2, 3.0), ("C", 4, 4.0)], "name string, k int, v double")
    facts = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "name string")
    got = sorted(tuple(r) for r in geo.active_candidates(st, facts, "name", order_col="k").collect())
    assert got == [("A", 1, 2.0), ("B", 2, 3.0)]


def test_nearest_with_dense_clusters_equals_brute_force(spark):
    rnd = random.Random(21)
    # a tight cluster of many distinct candidates plus a sparse background
    cs = [(i, round(10 + rnd.uniform(0, 0.5), 4), round(10 + rnd.uniform(0, 0.5), 4)) for i in range(300)]
    cs += [(300 + i, round(rnd.uniform(-100, 100), 2), round(rnd.uniform(-100, 100), 2)) for i in range(40)]
    qs = [(i, round(rnd.uniform(-120, 120), 2), round(rnd.uniform(-120, 120), 2)) for i in range(150)]
    qs += [(150 + i, round(10 + rnd.uniform(-0.2, 0.7), 4), round(10 + rnd.uniform(-0.2, 0.7), 4)) for i in range(80)]
    q = spark.createDataFrame(qs, "qid int, x double, y double")
    c = spark.createDataFrame(cs, "cid int, x double, y double")
    got = geo.nearest_l1(q, c, "qid", "x", "y", "x", "y", "cid", ["cid"], 1.0, 1.0, per_cell=2.0, dense_factor=4.0)
    res = {r.qid: (r.cid, round(r.distance, 6)) for r in got.collect()}
    assert res == _brute_nearest(qs, cs, 1.0, 1.0)


def test_shared_coordinates_flags_namesakes(spark):
    gaz = geo.gazetteer_from_nested(spark, {"A": {"x": [1.0, 2.0], "y": [3.0, 4.0]}, "B": {"x": [1.0, 2.0]},
                                            "C": {"z": ["nodata", "nodata"]}})
    rows = geo.shared_coordinates(gaz).collect()
    assert [(r.lat, r.lng, r.regions) for r in rows] == [(1.0, 2.0, 2)]


def test_indexed_lookup_equals_literal_on_odd_rows(spark):
    """Repeated and null ids, equal texts, empty and null names, a name shorter than a gram."""
    gaz = spark.createDataFrame([(0, None, "x", 9.0, 9.0), (1, "red", "", 1.0, 1.0), (2, "blue", "sky", 2.0, 2.0), (3, "b", "q", 3.0, 3.0),
                                 (4, "", "green", 4.0, 4.0), (5, "a very long region name", "sky", 5.0, 5.0)], GAZETTEER_SCHEMA)
    texts = ["red", "the blue sky", "blue", "bq", "b", "green", "", None, "sky over a very long region name " * 40, "x" * 2000 + "blue" + "y" * 1500 + "sky"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "red"), (None, "the blue sky"), (1, "green"), (1, "green"), (1, "nothing")]
    df = spark.createDataFrame(rows, "id int, t string")
    both = [sorted((str(tuple(r)) for r in geo.place_lookup(df, "t", gaz, drop_missing=drop, literal_max=m).collect()))
            for drop in (True, False) for m in (100, 0)]
    assert both[0] == both[1] and both[2] == both[3] and len(both[2]) == len(rows) and len(both[0]) == len(rows) - 1
    any_text = gaz.unionByName(spark.createDataFrame([(7, "", "", 7.0, 7.0)], GAZETTEER_SCHEMA))
    both = [sorted((str(tuple(r)) for r in geo.place_lookup(df, "t", any_text, literal_max=m).collect())) for m in (100, 0)]
    assert both[0] == both[1]
    assert geo.place_lookup(df, "t", gaz.limit(0), literal_max=-1).where("wide IS NOT NULL").count() == 0


def test_nearest_two_far_clusters_and_collinear(spark):
    """Clusters a billion apart, candidates on lines that tie for far queries, a crowd in one leaf."""
    rnd = random.Random(4)
    cs = [(i, float(i), float(400 - i)) for i in range(400)] + [(400 + i, 1e9 + i * 1e-3, 1e9) for i in range(300)]
    cs += [(700 + i, 1e9 + 5, 1e9 + 1e-6 * i) for i in range(100)] + [(900, float("nan"), 1.0), (901, float("inf"), 1.0)]
    qs = [(i, rnd.uniform(-1000, 1000), rnd.uniform(-1000, 1000)) for i in range(60)] + [(60 + i, 1e9 + rnd.uniform(-1, 6), 1e9 + rnd.uniform(-1, 1)) for i in range(60)]
    qs += [(200 + i, -5000.0 - i, -5000.0 + 3 * i) for i in range(20)] + [(300, 5e8, 5e8), (301, None, 1.0), (302, float("nan"), 1.0)]
    q = spark.createDataFrame(qs, "qid int, x double, y double")
    c = spark.createDataFrame(cs, "cid int, x double, y double")
    got = {r.qid: (r.cid, r.distance) for r in geo.nearest_l1(q, c, "qid", "x", "y", "x", "y", "cid", ["cid"]).collect()}
    want = _brute_nearest([x for x in qs if x[0] != 302], [x for x in cs if x[0] < 900], 1.0, 1.0)
    assert {k: v[0] for k, v in got.items()} == {**{k: v[0] for k, v in want.items()}, 302: None}


def test_pyramid_pairs_stay_few(spark):
    """Whole coordinates that all tie for the queries: only cells with a lower order are entered."""
    from stationlink.operators.pyramid import Pyramid
    pts = spark.range(4000).select(F.col("id").alias("_ord"), F.col("id").cast("double").alias("_x"), (4000.0 - F.col("id")).alias("_y"))
    tree = Pyramid(pts, 16)
    q = spark.createDataFrame([(-9000.0 - i, -9000.0 + i) for i in range(50)], "_qx double, _qy double")
    start = q.select("_qx", "_qy", (F.col("_qx") * 0).cast("long").alias("_pi"), (F.col("_qx") * 0).cast("long").alias("_pj"))
    best = tree._down(start, None).groupBy("_qx", "_qy").agg(F.min_by(F.struct("_d", "_ord"), F.struct("_d", "_ord")).alias("_b"))
    assert tree._down(start.join(best, ["_qx", "_qy"]), True).count() <= 50 * 32
    assert {r._m._ord for r in tree.nearest(q).collect()} == {0}
