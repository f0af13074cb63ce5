"""Findings of round 3: the gram index lists each distinct word once, whatever way the
words meet the texts; blocks of texts are read one at a time."""

from __future__ import annotations

import random

import pytest

from stationlink.operators import geo
from stationlink.schemas import GAZETTEER_SCHEMA


@pytest.mark.parametrize("common, size", [(1000, 1 << 25), (1000, 0), (0, 1 << 25), (0, 0)])
def test_indexed_lookup_by_words(spark, monkeypatch, common, size):
    """Names of several words, names that span words, space-only names, entries of one order;
    words broadcast or shuffled; common entries under the empty word."""
    monkeypatch.setattr(geo, "COMMON_WORDS", common)
    gaz = [(0, "New York", "the bay", 1.0, 1.0), (1, "d b", "e", 2.0, 2.0), (2, "ed", "lue", 3.0, 3.0), (3, "\n", " ", 4.0, None),
           (4, "York", "", 5.0, 5.0), (4, "absent", "word", 6.0, 6.0), (5, "e", "e", 7.0, 7.0), (6, "ed", "lue", 8.0, 8.0)]
    rnd = random.Random(5)
    words = ["New York", "New", "York", "the", "bay", "the bay", "red", "blue", "end", "b", "\n", "absent", "xy"]
    texts = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6)))) for i in range(150)] + [(200, ""), (201, None), (None, "red blue")]
    df = spark.createDataFrame(texts, "id int, t string")

    def first(t):
        fits = [e for e in gaz if t is not None and e[1] in t and e[2] in t]
        return tuple(min(fits, key=lambda e: e[0])[1:]) if fits else (None,) * 4
    got = geo._substring_join_lookup(df, "t", spark.createDataFrame(gaz, GAZETTEER_SCHEMA), piece=2, broadcast_bytes=size)
    assert sorted(map(str, got.collect())) == sorted(map(str, [r for r in spark.createDataFrame(
        [(i, t, *first(t)) for i, t in texts], got.schema).collect()]))


def test_indexed_lookup_entries_of_one_order(spark):
    """Two entries with the same order are looked for each by its own gram."""
    gaz = spark.createDataFrame([(0, "red", "rod", 1.0, 1.0), (0, "blue", "sky", 2.0, 2.0)], GAZETTEER_SCHEMA)
    df = spark.createDataFrame([(1, "a red rod"), (2, "a blue sky"), (3, "red sky")], "id int, t string")
    got = {r.id: r.wide for r in geo.place_lookup(df, "t", gaz, literal_max=0).collect()}
    assert got == {1: "red", 2: "blue", 3: None}


def test_lm_blocks_one_at_a_time(spark, tmp_path, monkeypatch):
    """No batch that the requests are made from holds more than one block; settings come back."""
    lm = pytest.importorskip("stationlink.llm.lm")
    monkeypatch.setattr(lm, "BLOCK", 1 << 12)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows])], names=["n"])
    docs = spark.createDataFrame([(i, "some words " * 200) for i in range(30)], "id int, text string").coalesce(1)
    path = str(tmp_path / "blocks")
    docs.selectExpr("id", "array(text, text) AS texts").write.parquet(path)
    with lm._one_block(spark):
        n = [r.n for r in spark.read.parquet(path).mapInArrow(sizes, "n long").collect()]
    assert n == [1] * 30 and spark.conf.get(key, None) == before
