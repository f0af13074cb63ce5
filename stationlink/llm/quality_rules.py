"""Weak supervision over quality rules, with DataFrame functions only.

Each rule votes good (1) or bad (0) or abstains (-1). The votes of a document are one of
at most 2^rules patterns; their counts over all documents are all that expectation
maximisation needs (a bounded table, whatever the corpus). It estimates each rule's
accuracy, and a document's verdict is its posterior probability of being good (even odds
before any vote).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_SEP, Scratch, read
from .linededup import let

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEEP_AT = 0.5  # posterior probability of being good from which a document is kept
START = 0.85        # accuracy a rule starts with
CLEAN = "50 * n_symbols < n_words AND 50 * n_shouts < n_words AND 10 * n_capitals < 3 * word_chars"

# (name, vote, when) over the columns of ``features``; the rule abstains otherwise. Signs of
# junk vote bad, signs of prose vote good: that a sign is missing says nothing.
RULES: list[tuple[str, int, str]] = [
    ("symbols", 0, "10 * n_symbols > n_words"),
    ("dup_lines", 0, "n_lines > 3 AND 10 * n_dup_lines > 5 * n_lines"),
    ("repeats", 0, "100 * n_repeat_words > 35 * n_words"),
    ("capitals", 0, "10 * n_capitals > 4 * word_chars"),
    ("variety", 0, "100 * n_distinct < 20 * n_words AND n_words < 5000"),
    ("shouting", 0, "5 * n_shouts > n_words"),
    ("word_length", 0, "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("prose", 1, f"{CLEAN} AND word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    ("rich", 1, f"{CLEAN} AND 100 * n_distinct > 45 * n_words"),
    ("fresh", 1, f"{CLEAN} AND 100 * n_repeat_words < 10 * n_words"),
]


def _without(text: str, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts over the whole text of every row: n_words, word_chars, n_symbols, n_lines (lines
    with a word), n_dup_lines, n_repeat_words, n_distinct, n_capitals, n_shouts. All are
    0 for null and empty text."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    df = let(df, s=F.btrim("t", F.lit(SPACE)))
    df = let(df, w=F.when(F.col("s") == "", F.array().cast("array<string>")).otherwise(F.split("s", WORD_SEP)),
             lines=F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    df = let(df, h=F.transform("w", lambda x: F.xxhash64(x)), n=F.size("w"))
    two = F.zip_with("h", F.slice("h", 2, F.greatest("n", F.lit(1))), lambda a, b: F.xxhash64(a, b))
    three = F.zip_with(two, F.slice("h", 3, F.greatest("n", F.lit(1))), lambda a, b: F.xxhash64(a, b))
    df = let(df, win=F.slice(three, 1, F.greatest(F.col("n") - 2, F.lit(0))))
    # windows in hash order with their place: equal neighbours are repeated windows
    placed = F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    df = let(df, z=F.when(F.size(F.array_distinct("win")) < F.size("win"), placed))
    nxt = F.slice("z", 2, F.greatest(F.size("z"), F.lit(1)))
    first = F.zip_with("z", nxt, lambda a, b: F.when(a.h == b.h, a.p))
    second = F.zip_with("z", nxt, lambda a, b: F.when(a.h == b.h, b.p))
    df = let(df, at=F.array_sort(F.array_compact(F.array_union(first, second))))
    gaps = F.zip_with("at", F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))),
                      lambda a, b: F.when(b.isNull(), 3).otherwise(F.least(F.lit(3), b - a)))
    n_chars = F.length("t")
    return df.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), _without("t", SPACE).cast("long").alias("word_chars"),
        (n_chars - _without("t", SYMBOLS)).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(gaps, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("h")).cast("long").alias("n_distinct"),
        (n_chars - _without("t", CAPITALS)).cast("long").alias("n_capitals"),
        (n_chars - _without("t", "!")).cast("long").alias("n_shouts"))


def votes(df: DataFrame) -> DataFrame:
    """Add the column ``votes``: an array with 1, 0 or -1 of each rule."""
    return df.withColumn("votes", F.array(*[
        F.when(F.expr(cond), vote).otherwise(-1).cast("int") for _, vote, cond in RULES]))


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> list[float]:
    """Accuracy of each rule (how often it is right when it votes) by expectation
    maximisation over (votes, count): a row is good with the log-odds of the accuracies
    that vote for it less those that vote against it; an accuracy is the share of its
    votes that this agrees with, with one row of pseudo-votes at ``START`` and kept within
    [0.55, 0.99], so that good and bad cannot swap."""
    m = len(patterns[0][0]) if patterns else 0
    acc = [START] * m
    for _ in range(rounds):
        right, cast = [START] * m, [1.0] * m
        for v, n in patterns:
            p = posterior(v, acc)
            for j, x in enumerate(v):
                if x >= 0:
                    right[j] += n * (p if x else 1 - p)
                    cast[j] += n
        new = [min(max(r / c, 0.55), 0.99) for r, c in zip(right, cast, strict=True)]
        moved = max((abs(a - b) for a, b in zip(acc, new, strict=True)), default=0.0)
        acc = new
        if moved < 1e-9:
            break
    return acc


def weight(vote: int, accuracy: float) -> float:
    """Log-odds for good that a vote adds."""
    return 0.0 if vote < 0 else (2 * vote - 1) * math.log(accuracy / (1 - accuracy))


def posterior(v: tuple[int, ...], acc: list[float]) -> float:
    return 1 / (1 + math.exp(-sum(weight(x, a) for x, a in zip(v, acc, strict=True))))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     scratch: Scratch | None = None) -> DataFrame:
    """The columns of ``features`` with votes, base_failed, p_good and kept. A document
    that fails the base test (under 50 words, or over half of its words in repeated 3-word
    windows) is not kept. Null and empty texts have no word and fail it. Repeated or null
    ids give a row each; an empty table gives none."""
    scratch = scratch or Scratch(docs.sparkSession, "qualityrules")
    df = scratch.save(votes(features(docs, id_col, text_col)), "votes")
    counts = [(tuple(r.votes), r["count"]) for r in sorted(df.groupBy("votes").count().collect(), key=lambda r: r.votes)]
    z = F.lit(0.0)
    for j, a in enumerate(fit(counts)):
        v = F.col("votes")[j]
        z = z + F.when(v == 1, weight(1, a)).when(v == 0, weight(0, a)).otherwise(0.0)
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    out = df.withColumn("base_failed", failed).withColumn("p_good", 1 / (1 + F.exp(-z)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_AT))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
