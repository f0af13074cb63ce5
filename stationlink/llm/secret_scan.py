"""Secret scan over a trigram inverted index, with DataFrame functions only.

Each rule is a regular expression. From its syntax tree follows a Boolean query over
trigrams that any match must contain (an AND of ORs of ANDs). The index holds, for every
trigram of those queries, the documents that have it (A-Z as a-z); a rule's postings are
united and intersected into its candidate documents, and only those are read with the
regular expression. A rule without mandatory trigrams is run over all documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read
from .linededup import let


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Java and Python; a match counts if its ``group``
    has ``least`` characters or more (spans are of whole matches)."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    # beyond the base kinds
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]+", 0, 24),
    Rule("basic_auth_url", r"[a-z]+://[A-Za-z0-9._~-]+:[A-Za-z0-9._~%!-]+@"),
]
BASE = ("assign", "access", "hex")
MAX_STRINGS = 64  # alternatives of one run of literals that are followed

Clause = frozenset[frozenset[str]]  # OR of ANDs of trigrams


def trigram_query(pattern: str) -> list[Clause]:
    """AND of clauses that every match of the pattern satisfies, over lower-case
    trigrams; [] if none is mandatory."""
    clauses: list[Clause] = []
    runs = _walk(re._parser.parse(pattern), clauses)
    _close(runs, clauses)
    return list(dict.fromkeys(clauses))


def _close(run: set[str], clauses: list[Clause]) -> None:
    """End a run of literals: each of its strings of three or more characters requires its trigrams."""
    grams = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in run]
    if grams and all(grams):
        least = [g for g in grams if not any(h < g for h in grams)]
        clauses.append(frozenset(least))


def _walk(tree, clauses: list[Clause], run: set[str] | None = None) -> set[str]:
    """Strings that may end what has been read so far; closed runs go to ``clauses``."""
    run = {""} if run is None else run
    for op, arg in tree:
        name = str(op)
        if name == "SUBPATTERN":
            run = _walk(arg[3], clauses, run)
            continue
        exact = _exact(op, arg)
        if exact is not None and len(run) * len(exact) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, exact)}
            continue
        _close(run, clauses)
        if name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            _close(_walk(arg[2], clauses), clauses)
        run = {""}
    return run


def _exact(op, arg) -> set[str] | None:
    """All strings of a node, lower-cased, or None if they are too many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        chars = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < MAX_STRINGS:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if name == "BRANCH":
        each = [_sequence(t) for t in arg[1]]
        return None if None in each else set().union(*each)
    if name == "SUBPATTERN":
        return _sequence(arg[3])
    if name == "MAX_REPEAT" and arg[1] <= 2:
        one = _sequence(arg[2])
        if one is None:
            return None
        return set().union(*[{"".join(x) for x in product(one, repeat=k)} for k in range(arg[0], int(arg[1]) + 1)])
    if name == "AT":
        return {""}
    return None


def _sequence(tree) -> set[str] | None:
    out = {""}
    for op, arg in tree:
        x = _exact(op, arg)
        if x is None or len(out) * len(x) > MAX_STRINGS:
            return None
        out = {a + b for a, b in product(out, x)}
    return out


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (trigram, doc_id) of the given lower-case trigrams."""
    low = let(docs, low=F.lower("text"))
    have = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("doc_id", F.explode(have).alias("trigram"))


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, kinds): the rules whose trigram query the document's postings satisfy. All
    postings of a document meet under its id: at most one per trigram of the rules."""
    held = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("has"))

    def satisfied(rule: Rule) -> Column:
        every = []
        for clause in trigram_query(rule.pattern):
            ways = [reduce(lambda a, b: a & b, [F.array_contains("has", t) for t in sorted(g)]) for g in sorted(clause, key=sorted)]
            every.append(reduce(lambda a, b: a | b, ways))
        return reduce(lambda a, b: a & b, every)

    kinds = F.array_compact(F.array(*[F.when(satisfied(r), F.lit(r.kind)) for r in rules]))
    return held.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans(text: str, rule: Rule) -> Column:
    """Array of (start, end) code points, end exclusive, of the rule's matches: leftmost,
    not overlapping, then those with a long enough group. Places follow from the lengths
    of the matches and of the pieces between them."""
    p = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    part = found if rule.group == 0 else F.regexp_extract_all(text, p, F.lit(rule.group))
    steps = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), found.alias("hit"), part.alias("part"))
    start = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out")),
        lambda s, x: F.when(x["hit"].isNull(), s).otherwise(F.struct(
            (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.when(F.length(x["part"]) >= rule.least, F.concat(s["out"], F.array(F.struct(
                (s["at"] + F.length(x["gap"])).alias("s"), (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("e")))))
            .otherwise(s["out"]).alias("out"))),
        lambda s: s["out"])
    none = F.array().cast("array<struct<s:int,e:int>>")
    return F.when(F.rlike(text, p), start).otherwise(none)


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, secrets) for every row: secrets is an array of (start, rank, end, kind)
    sorted so, rank being the rule's place in the list. Null and empty text has none.
    Repeated ids get their own rows, and so do null ids: rows of one id, null too, are
    scanned by the rules that any of them is a candidate of."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "secretscan")
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    keyed = [r for r in rules if queries[r.kind]]
    grams = sorted({t for r in keyed for clause in queries[r.kind] for g in clause for t in g})
    full = src
    if keyed:
        index = scratch.save(postings(src, grams), "postings")
        cand = scratch.save(candidates(index, keyed), "candidates")
        # candidates are few ids and names: joined by size, broadcast or shuffled
        cand = cand.withColumnRenamed("doc_id", "cand_id")
        full = src.join(cand, F.col("doc_id").eqNullSafe(F.col("cand_id")), "left").drop("cand_id")
    else:
        full = src.withColumn("kinds", F.array().cast("array<string>"))
    empty = F.array().cast("array<struct<s:int,e:int>>")
    found = {f"r{i}": (F.when(F.array_contains("kinds", r.kind), spans("text", r)).otherwise(empty) if queries[r.kind] else spans("text", r))
             for i, r in enumerate(rules)}
    full = let(full, **found)

    def tagged(i: int, kind: str) -> Column:
        return F.transform(f"r{i}", lambda x: F.struct(x.s.alias("start"), F.lit(i).alias("rank"), x.e.alias("end"), F.lit(kind).alias("kind")))

    return full.select("doc_id", F.array_sort(F.concat(*[tagged(i, r.kind) for i, r in enumerate(rules)])).alias("secrets"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(read(spark, sf_dir, "documents"))
    text = lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))
    base = F.filter("secrets", lambda x: x.kind.isin(*BASE))
    count = lambda k: F.size(F.filter("secrets", lambda x: x.kind == k)).cast("long").alias(f"n_{k}")
    return df.select("doc_id", *[count(k) for k in BASE],
                     F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
                     F.array_join(F.transform("secrets", text), ",").alias("spans"))
