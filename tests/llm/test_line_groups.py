"""Groups of lines that are alike: which of them are compared, and the sets of ids that are looked up."""

import random
from collections import Counter

from pyspark.sql import functions as F

from stationlink.llm import linededup


def test_lines_of_repeated_words_are_not_compared(spark, monkeypatch):
    """Lines of one word many times with a common end share keys, and words that come an even number of times
    leave no parity: their numbers do. Lines within their word edits are linked all the same."""
    r = random.Random(5)
    vocabulary = list({"".join(r.choice("abdefhinorst") for _ in range(6)) for _ in range(60)})
    lines = [" ".join([w] * n + "then end there for the last word".split()) for w in vocabulary for n in (32, 34, 64)]
    r.shuffle(lines)
    compared, link_buckets = [], linededup.link_buckets

    def counting(members, verify, *args, **more):
        def counted(pairs):
            compared.append(pairs.count())
            return verify(pairs)
        return link_buckets(members, counted, *args, **more)
    monkeypatch.setattr(linededup, "link_buckets", counting)
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {x.doc_id: x.kept for x in linededup.line_marks(df).collect()}
    # of each word, 32 and 34 are within two edits, 64 is alone
    first, want = set(), {}
    for i, line in enumerate(lines):
        w = line.split()
        group = (w[0], len(w) < 50)
        want[i] = group not in first
        first.add(group)
    assert got == want
    assert len(vocabulary) <= sum(compared) < 2 * len(lines), compared


def test_replaced_words_of_short_lines_are_not_compared(spark):
    """Lines of one length of which a word differs: the letters tell it."""
    r = random.Random(6)
    words = ["".join(r.choice("abdefhinorst") for _ in range(8)) for _ in range(200)]
    rows = [(f"a line of {x} and the rest alike", f"a line of {y} and the rest alike") for x, y in zip(words, words[1:])]
    df = spark.createDataFrame(rows, "a string, b string")
    for x in "ab":
        df = linededup.let(df, **{f"g{x}": linededup.word_segments(x)})
        df = linededup.let(df, **{f"s{x}": linededup.sketch(x, f"length({x})", linededup.n_words(x), f"g{x}")})
    assert df.where(linededup.may_chars("sa", "sb", 2)).count() < 0.2 * len(rows)


def test_numbered_hashes_keep_the_difference_of_their_numbers(spark):
    r = random.Random(7)
    rows = [([r.randrange(6) for _ in range(r.choice((0, 1, 5, 40)))], [r.randrange(6) for _ in range(r.choice((0, 3, 40)))]) for _ in range(200)]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>").select("a", "b", F.expr(linededup.numbered("a")).alias("x"), F.expr(linededup.numbered("b")).alias("y"))
    for a, b, x, y in df.collect():
        assert len(set(x)) == len(x) == len(a) and len(set(y)) == len(b)
        p, q = Counter(a), Counter(b)
        assert len(set(x) ^ set(y)) == sum(((p - q) + (q - p)).values())


def test_sieve_lets_all_ids_through_and_few_others(spark, monkeypatch):
    df = spark.range(20_000).select(F.xxhash64("id").alias("id"), F.col("id").alias("line"))
    ids = df.where("line % 10 = 0").select("id")
    got = {x.line for x in linededup._sieve(df, ids).collect()}
    assert got >= set(range(0, 20_000, 10)) and len(got) < 2_500
    assert linededup._sieve(df, ids.where("false")).count() == 0
    # a map that is too small lets more rows through, none less
    monkeypatch.setattr(linededup, "SIEVE_MOST", 1 << 10)
    assert {x.line for x in linededup._sieve(df, ids).collect()} >= set(range(0, 20_000, 10))
