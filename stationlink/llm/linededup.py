"""Line deduplication by a segment-partition edit join, with DataFrame functions only.

Lines of ``MIN_CHARS`` or more code points within ``TAU`` edits (insert, delete, replace)
are linked, and lines of ``LONG_CHARS`` or more also within one edit of a whole word for
each ``WORDS_AN_EDIT`` words (between spaces) of the line that allows more. Of each
component of links only the first occurrence (smallest doc_id, nulls last, then hash of
the row, then line number) stays. Steps:

1. Equal lines become one (64-bit hash of the line: two different lines among 10^9 share
   one with probability 0.03). All that follows is done once for each different line.
2. A line is split into segments that end where a word ends in one of ``ENDS``, so that the
   cuts stay with the text when it grows or shrinks. An edit of a character or of a word
   changes two segments at most. Of n such edits, the first 2 n + 2 segments in an order of
   all segments (longer first, then by hash) have two in common with those of the other
   line, whose number of words differs by n at most; a line of fewer has one in common.
3. A line with too few such segments is also cut into TAU + 1 segments by length, its index
   entries (l, segment number, segment). Two lines within TAU edits share one segment, so
   a line of length L probes the entries of lengths L - TAU .. L with the few substrings
   whose position can still be right (bounds from the edits left and right of the
   segment). For word edits it uses t + 1 whole words.
4. Lines under an entry of more than LARGE lines (groups of near copies) are known by their
   rarest pairs of neighbouring words instead, so that those that differ from most of a
   group meet few of it (``_recut``).
5. Lines that meet under an entry and whose sketches allow it (length, words, letter counts,
   parities of words and segments) are compared: word by word by codes made once a line, or
   with a banded bit-parallel edit distance. ``links.link_buckets`` does so without pairing
   whole buckets of near copies, the lines most like the others of a group first.

A row is known by the hash of its doc_id and text, so rows that repeat an id, and rows
without one, have their own lines; rows equal in both keep or lose the same lines.
Lines below ``MIN_CHARS`` are left alone even when equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read
from .links import link_buckets

TAU = 2
MIN_CHARS = 20
PIECES = 16  # of a line, for finding what two lines begin and end with alike
LONG_CHARS = 80
WORDS_AN_EDIT = 16
ENDS = "bdfhjlnoprtvxz02468"  # of words that end a segment: a third to a half of them in most languages of Latin letters
LETTERS = "eatniorshd"       # counted in the sketch of a line
PARITIES = 2                 # 64-bit words of segment parities in the sketch
WORD_PARITIES = 4            # and of word parities
SIEVE_BITS = 16              # of the map of ids, for each
SIEVE_MOST = 1 << 27         # and at most
LARGE = 8                    # lines under one key, beyond which they are known by their rarest pairs of words


def let(df: DataFrame, replace: list | None = None, **cols: Column) -> DataFrame:
    """Add columns behind a one-row generator, so that the optimizer keeps them computed
    once instead of copying their expressions into each use. Those named in ``replace``
    take the place of columns of the same name."""
    others = [c for c in df.columns if c not in (replace or ())] if replace else ["*"]
    return df.select(*others, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def segment_keys(line: str, length: str, tau: int = TAU) -> str:
    """SQL: array of keys of a line: its tau + 1 index entries (last bit 1) first, then its other probes."""
    k = tau + 1
    index, probes = [], []
    for delta in range(k):
        for i in range(k):
            lo, hi = max(-i, delta - (tau - i)), min(i, delta + (tau - i))
            for shift in range(lo, hi + 1):
                (index if delta == shift == 0 else probes).append(f"named_struct('n', {delta}, 'i', {i}, 's', {shift})")
    # small steps over a literal array, not an expression for each key: a generated method of that size is never compiled
    places = f"transform(array({', '.join(index + probes)}), p -> named_struct('n', {length} - p.n, 'i', p.i, 's', p.s, 'e', p.n = 0 AND p.s = 0))"
    # of k segments the last (n mod k) have a character more
    cuts = f"""transform({places}, p -> named_struct('n', p.n, 'i', p.i, 'z', CAST(p.n DIV {k} AS INT) + IF(p.i >= {k} - p.n % {k}, 1, 0),
        'b', p.i * CAST(p.n DIV {k} AS INT) + greatest(p.i - {k} + p.n % {k}, 0) + p.s, 'e', p.e))"""
    fits = f"filter({cuts}, p -> p.n >= {MIN_CHARS} AND p.b >= 0 AND p.b + p.z <= {length})"
    return f"transform({fits}, p -> shiftleft(xxhash64(p.n, p.i, substring({line}, p.b + 1, p.z)), 1) | IF(p.e, 1, 0))"


def n_words(line: str) -> str:
    return f"(octet_length({line}) - octet_length(replace({line}, ' ', '')) + 1)"


def _ordered(texts: str) -> str:
    """Keys of texts: the length (up to 127) in the top byte, so that longer ones sort last, and 56 bits of the hash."""
    return f"transform({texts}, x -> shiftleft(CAST(least(length(x), 127) AS BIGINT), 56) | (xxhash64(x) & {(1 << 56) - 1}))"


def word_segments(line: str) -> Column:
    """Keys of the segments of a line, in its order."""
    return F.expr(_ordered(f"split({line}, ' (?<=[{ENDS}] )')"))


def line_keys(line: str, length: str, words: str, segments: str, tau: int = TAU) -> Column:
    """Array of keys of a line, the last bit 1 for entries: those are met by all lines of the same key, the others by entries only."""
    t = f"({words} DIV {WORDS_AN_EDIT - 1})"            # a partner with more words allows so many edits at most
    top = "transform(slice(sort_array(array_distinct({}), false), 1, {}), k -> shiftleft(k, 1) | 1)"
    own = top.format(segments, f"greatest(2 * {t}, {2 * tau}) + 2")
    whole = top.format(_ordered(f"split({line}, ' ')"), f"IF({t} > 0, {t} + 1, 0)")
    # an edit changes the number of segments by one: a partner has more than 2 t and 2 tau of them
    return F.expr(f"IF(size({segments}) > greatest(3 * {t}, {3 * tau}), {own}, concat({own}, {whole}, {segment_keys(line, length, tau)}))")


def word_edits(length: str, words: str) -> str:
    """SQL: edits of whole words that a line allows."""
    return f"IF({length} >= {LONG_CHARS}, {words} DIV {WORDS_AN_EDIT}, 0)"


def _parities(name: str, hashes: str, n: int) -> str:
    """SQL: fields of a struct, the parities of the numbers of hashes that fall on each of 64 n bits."""
    return ", ".join(f"'{name}{k}', aggregate({hashes}, 0L, (s, x) -> IF(x & {n - 1} = {k}, s ^ shiftleft(1L, CAST(shiftright(x, 4) & 63 AS INT)), s))" for k in range(n))


def numbered(hashes: str) -> str:
    """SQL: the hashes of an array, each with the number of equal ones before it, so that equal ones are told apart.
    As sets, two such arrays differ by as much as the hashes do with their numbers."""
    runs = f"""transform(transform(array(array_sort({hashes})), s -> named_struct('s', s, 'p', filter(sequence(0, size(s)), i -> i = 0 OR i = size(s) OR s[i] != s[i - 1]))),
        r -> flatten(transform(slice(r.p, 1, size(r.p) - 1), (b, j) -> transform(sequence(b, r.p[j + 1] - 1), i -> xxhash64(r.s[b], i - b)))))[0]"""
    return f"IF(size({hashes}) = 0, array(), {runs})"


def sketch(line: str, length: str, words: str, segments: str) -> Column:
    """n: code points, m: words, t: edits of words allowed, c0 ..: counts of LETTERS, p0 ..: parities of the numbers
    of segments by their hash, w0 ..: of words, equal ones numbered, of lines that allow edits of words. An edit changes
    two counts by one at most, an edit of a word three parities of segments, and two of words (one if the number of
    words changes). Without their numbers, words that come an even number of times would go unseen."""
    counts = ", ".join(f"'c{i}', length({line}) - length(replace({line}, '{x}', ''))" for i, x in enumerate(LETTERS))
    words_of = f"transform(array(transform(split({line}, ' '), x -> xxhash64(x))), h -> {numbered('h')})[0]"
    hashes = f"IF({length} >= {LONG_CHARS}, {words_of}, array())"
    fields = f"'n', {length}, 'm', CAST({words} AS INT), 't', CAST({word_edits(length, words)} AS INT), {counts}, {_parities('p', segments, PARITIES)}, {_parities('w', 'h', WORD_PARITIES)}"
    return F.expr(f"transform(array({hashes}), h -> named_struct({fields}))[0]")


def may_chars(x: str, y: str, tau: int) -> str:
    """SQL: the sketches allow ``tau`` edits."""
    off = " + ".join(f"abs({x}.c{i} - {y}.c{i})" for i in range(len(LETTERS)))
    return f"(abs({x}.n - {y}.n) <= {tau} AND {off} <= {2 * tau})"


def may_words(x: str, y: str) -> str:
    """SQL: the sketches allow the word edits of the line that allows more (a shorter line
    than ``LONG_CHARS`` has no parities of words)."""
    def off(name: str, n: int) -> str:
        return " + ".join(f"bit_count({x}.{name}{k} ^ {y}.{name}{k})" for k in range(n))
    t = f"greatest({x}.t, {y}.t)"
    w = f"(least({x}.n, {y}.n) < {LONG_CHARS} OR {off('w', WORD_PARITIES)} <= 2 * {t} - abs({x}.m - {y}.m))"
    return f"({t} > 0 AND abs({x}.m - {y}.m) <= {t} AND {w} AND {off('p', PARITIES)} <= 3 * {t})"


def word_codes(line: str, allowed: str) -> Column:
    """The words of a line as one of 2^20 characters each by their hash, in two ways (a changed word goes
    unseen with probability 2^-40), once for each line; empty unless words may be edited."""
    def code(shift: int) -> str:
        return f"decode(unhex(array_join(transform(h, x -> substring(hex(4295032832 + (shiftright(x, {shift}) & 1048575)), 2)), '')), 'UTF-32')"
    hashes = f"IF({allowed}, transform(split({line}, ' '), x -> xxhash64(x, 1)), array())"
    return F.expr(f"transform(array({hashes}), h -> named_struct('x', {code(0)}, 'y', {code(20)}))[0]")


def words_within(a: str, b: str, tau: str) -> Column:
    """Whether two lines, given by their codes of words, are within ``tau`` (SQL) edits of words."""
    return F.expr(" AND ".join(f"levenshtein({a}.{n}, {b}.{n}, CAST({tau} AS INT)) >= 0" for n in "xy"))


def uncommon(df: DataFrame, a: str, b: str, out_a: str, out_b: str) -> DataFrame:
    """Adds the two texts without whole words that they begin and end with alike (found by
    pieces, so not all of them): their edit distances, of characters and of words, are the same."""
    def alike(side: str) -> Column:
        return F.expr(f"size(filter(sequence(1, {PIECES - 1}), i -> {side}({a}, i * _p) = {side}({b}, i * _p))) * _p")
    df = let(df, _p=F.expr(f"least(length({a}), length({b})) DIV {PIECES}"))
    df = let(df, _k=alike("left"), _e=alike("right"))
    # to the last space of the alike beginning, from the first space of the alike end
    df = let(df, ["_e", "_k"], _e=F.expr(f"CAST(least(_e, {PIECES - 1} * _p - _k) AS INT)"), _k=F.expr(f"CAST(_k - length(substring_index(left({a}, CAST(_k AS INT)), ' ', -1)) AS INT)"))
    df = let(df, ["_e"], _e=F.expr(f"_e - length(substring_index(right({a}, _e), ' ', 1))"))
    cut = "substring({0}, _k + 1, length({0}) - _k - _e)"
    return let(df, **{out_a: F.expr(cut.format(a)), out_b: F.expr(cut.format(b))}).drop("_p", "_k", "_e")


def within(a: str, b: str, tau: int = TAU) -> Column:
    """Whether two texts without line feeds are within ``tau`` edits: one machine word
    holds the vertical differences of a band of 2 * tau + 2 diagonals (Hyyro 2003)."""
    w = 2 * tau + 2
    full, top = (1 << w) - 1, 1 << (w - 1)
    vp0 = ((1 << (tau + 1)) - 1) << (w - tau - 1)
    s1, s2 = f"IF(length({a}) >= length({b}), {a}, {b})", f"IF(length({a}) >= length({b}), {b}, {a})"
    pad = f"array_repeat('\\n', {w})"
    d0 = "((((x & s.vp) + s.vp) ^ s.vp) | x | s.vn)"
    hp = f"(s.vn | ~({d0} | s.vp))"
    hn = f"({d0} & s.vp)"
    mask = " + ".join(f"IF(element_at(q.p, i + {k + tau + 2}) = c, {1 << k}L, 0L)" for k in range(w))
    # below row len1 - tau the band's last diagonal leaves the matrix: follow its last row instead
    edge = f"shiftrightunsigned({top >> 1}L, s.i - CAST(q.n1 - {tau} AS INT))"
    step = f"""named_struct(
        'i', s.i + 1,
        'vp', ({hn} | ~(shiftright({d0} & {full}L, 1) | {hp})) & {full}L,
        'vn', (shiftright({d0} & {full}L, 1) & {hp}) & {full}L,
        'd', IF(s.i < q.n1 - {tau}, s.d + IF({d0} & {top}L = 0, 1, 0),
                s.d + IF({hp} & {edge} != 0, 1, 0) - IF({hn} & {edge} != 0, 1, 0)))"""
    # q: the padded longer text and the match masks, held once by a one-element array
    return F.expr(f"""{a} = {b} OR
        transform(transform(array(named_struct('n1', length({s1}), 'p', concat({pad}, split({s1}, ''), {pad}), 'c', split({s2}, ''))),
            q -> named_struct('n1', q.n1, 'x', transform(q.c, (c, i) -> {mask}))),
          q -> aggregate(q.x, named_struct('i', 0, 'vp', {vp0}L, 'vn', 0L, 'd', {tau}), (s, x) -> {step}, s -> s.d))[0] <= {tau}""")


LAST = (1 << 63) - 1


def row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), row_hash(id_col, text_col).alias("row"),
                      F.col(text_col).cast("string").alias("t"))
    rows = src.where("t IS NOT NULL").select("doc", "row", F.posexplode(F.split("t", "\n")).alias("line_no", "line"))
    return let(rows, n=F.length("line"))


def _sieve(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id (a 64-bit hash) is in ``ids``, and a few more: a broadcast map of ``SIEVE_BITS`` bits an id
    (``SIEVE_MOST`` at most; beyond, more rows pass) has three bits of each in one word. So the rows are not shuffled."""
    bits = 1 << min(max(SIEVE_BITS * ids.count(), 64).bit_length(), SIEVE_MOST.bit_length() - 1)
    at = f"shiftright(id & {bits - 1}, 6)"
    own = " | ".join(f"shiftleft(1L, CAST({x} & 63 AS INT))" for x in ("id", "shiftright(id, 52)", "shiftright(id, 58)"))
    marks = ids.select(F.expr(at).alias("_at"), F.expr(own).alias("x"))
    marks = marks.groupBy("_at").agg(F.expr("bit_or(x)").alias("_marks"))
    return df.withColumn("_at", F.expr(at)).join(F.broadcast(marks), "_at").where(f"(~_marks & ({own})) = 0").select(*df.columns)


def _candidates(lines: DataFrame, tau: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(key, id) of all lines (id, line) that share entries with lines of about as many words, and their ids."""
    lines = let(lines, n=F.length("line"), m=F.expr(n_words("line")), g=word_segments("line"))
    few = F.expr(f"size(g) <= greatest(3 * (m DIV {WORDS_AN_EDIT - 1}), {3 * tau}) OR size(array_distinct(g)) < greatest(2 * (m DIV {WORDS_AN_EDIT - 1}), {2 * tau}) + 2")
    rows = lines.select("id", F.col("m").cast("int").alias("m"), F.when(few, 1).otherwise(2).alias("need"), F.explode(line_keys("line", "n", "m", "g", tau)).alias("k"))
    rows = rows.select("id", "m", "need", F.expr("shiftright(k, 1)").alias("key"), F.expr("CAST(k & 1 AS INT)").alias("entry"))
    # one shuffle; the window of a very common key spills, it is never held in memory. In the
    # order of the words, a line with a partner has a neighbour that is near enough
    met = "OVER (PARTITION BY key ORDER BY m"
    rows = rows.select("key", "id", "need", "m", F.expr(f"lag(m) {met})").alias("before"), F.expr(f"lead(m) {met})").alias("after"),
                       F.expr(f"max(entry) {met} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)").alias("met"))
    off = f"greatest(m DIV {WORDS_AN_EDIT - 1}, {tau})"
    rows = scratch.save(rows.where(f"met = 1 AND (m - before <= {off} OR after - m <= {off})").select("key", "id", "need").distinct(), "met")
    scratch.free()
    ids = scratch.save(rows.groupBy("id").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need").select("id"), "ids")
    members = scratch.save(rows.select("key", "id").join(ids, "id", "left_semi"), "members")
    scratch.drop(rows)
    return members, ids


def _recut(members: DataFrame, lines: DataFrame, tau: int, scratch: Scratch) -> DataFrame:
    """(key, id, rank): ``members`` with other keys in place of those of more than ``LARGE`` lines.

    Two linked lines that share such keys only are both among the lines under them. Of n edits
    of words each takes two pairs of neighbouring words from a line at most, an edit of a
    character three (equal pairs of a line are numbered). So of e pairs that may go, the e + 1 rarest of a line (an order over all
    these lines) have one in common with those of the other line, if one of the two has more
    than e pairs. Lines of a group of near copies that differ from most of it meet only
    those that differ in the same way. Lines with e pairs or fewer also keep their keys."""
    large = scratch.save(members.groupBy("key").agg(F.count("*").alias("n")).where(f"n > {LARGE}").select("key"), "large")
    inside = scratch.save(members.join(large, "key", "left_semi"), "inside")
    ids = scratch.save(inside.select("id").distinct(), "inside-ids")
    words = let(_sieve(lines.select("id", "line"), ids), w=F.split("line", " "))
    words = let(words, ["w"], e=F.expr(f"greatest(2 * (size(w) DIV {WORDS_AN_EDIT - 1}), {3 * tau})"),
                h=F.expr("transform(slice(w, 2, size(w)), (x, i) -> xxhash64(w[i], x))"))
    few = inside.join(scratch.save(words.where("size(h) <= e").select("id"), "poor"), "id", "left_semi")
    # pairs of one line only come first in the order, so that the place from its end does not need them
    pairs = scratch.save(words.select("id", F.expr("size(h) - e").alias("last"), F.explode(F.expr(numbered("h"))).alias("gram")), "grams")
    seen = pairs.groupBy("gram").agg(F.count("*").alias("seen")).where("seen > 1")
    order = "OVER (PARTITION BY id ORDER BY seen DESC, gram DESC)"
    first = pairs.join(seen, "gram").select("id", "last", "gram", "seen", F.expr(f"row_number() {order}").alias("i"))
    first = scratch.save(first.where("i >= last").select("id", "gram", "seen"), "first")
    scratch.drop(pairs)
    # lines with common pairs only are in the midst of a group: pivots are taken from them first
    rank = scratch.save(first.groupBy("id").agg((-F.sum("seen")).alias("rank")), "rank")
    recut = first.select(F.xxhash64("gram", F.lit(1)).alias("key"), "id").join(rank, "id")
    zero = F.lit(0).cast("long").alias("rank")
    return (members.join(large, "key", "left_anti").select("key", "id", zero)
            .unionByName(few.select("key", "id", zero)).unionByName(recut.select("key", "id", "rank")))


def line_marks(docs: DataFrame, tau: int = TAU, id_col: str = "doc_id", text_col: str = "text",
               scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, row, line_no, chars, class_id, linked, kept) of every line of the texts,
    split at line feeds; ``row`` is the hash of the row. ``linked``: another line equals it
    or is linked with it. Lines of fewer than ``MIN_CHARS`` code points are kept, unlinked,
    and have no class."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "linededup")
    lines = _lines(docs, id_col, text_col)
    long = let(lines.where(F.col("n") >= MIN_CHARS), id=F.xxhash64("line"))
    # one row per distinct line; a very common line is combined before the shuffle
    distinct = scratch.save(long.groupBy("id").agg(F.min(F.struct("doc", "row", "line_no")).alias("at"), F.count("*").alias("occurs"),
                                                   F.first("line").alias("line")), "distinct")
    scratch.free()
    members, ids = _candidates(distinct.select("id", "line"), tau, scratch)
    text = scratch.save(_sieve(distinct.select("id", "line"), ids), "text")
    firsts = scratch.save(distinct.select("id", "at", "occurs"), "firsts")
    scratch.drop(distinct)
    scratch.free()
    cut = scratch.save(_recut(members, text, tau, scratch), "cut")
    shared = cut.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    cut = scratch.save(cut.join(shared, "key", "left_semi"), "shared")
    # lines that are alone under all of their keys have no partner
    known = _sieve(text, scratch.save(cut.select("id").distinct(), "partners"))
    known = let(known, n=F.length("line"), m=F.expr(n_words("line")), g=word_segments("line"))
    known = scratch.save(known.select("id", "line", sketch("line", "n", "m", "g").alias("sketch")), "known")

    met: list[DataFrame] = []

    def verify(pairs: DataFrame) -> DataFrame:
        scratch.drop(*met)
        pairs = scratch.save(pairs, "pairs")
        near = _sieve(known, scratch.save(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "sides"))
        near = scratch.save(near.withColumn("codes", word_codes("line", f"sketch.m >= {WORDS_AN_EDIT - 1}")), "near")
        met[:] = [pairs, near]
        p = pairs.join(near.selectExpr("id AS a", "line AS la", "sketch AS sa", "codes AS ka"), "a").join(
            near.selectExpr("id AS b", "line AS lb", "sketch AS sb", "codes AS kb"), "b")
        p = let(p, chars=F.expr(may_chars("sa", "sb", tau)), words=F.expr(may_words("sa", "sb")) & words_within("ka", "kb", "greatest(sa.t, sb.t)"))
        # characters are compared where the words leave it open
        p = let(p.where("chars OR words"), ["la", "lb"], **{x: F.expr(f"IF(words, '', {x})") for x in ("la", "lb")})
        p = uncommon(p, "la", "lb", "xa", "xb")
        return p.where(F.col("words") | within("xa", "xb", tau)).select("a", "b")

    comp, _ = link_buckets(cut, verify, scratch, python=False, may=lambda x, y: f"({may_chars(x, y, tau)} OR {may_words(x, y)})",
                           rank="rank", sketches=known.select("id", "sketch"))
    scratch.drop(*met)
    scratch.drop(members, ids, text)
    scratch.free()
    classes = firsts.join(comp, "id", "left").select(
        "id", "at", "occurs", F.coalesce("comp", "id").alias("class_id"))
    heads = classes.groupBy("class_id").agg(F.min("at").alias("first"), F.sum("occurs").alias("n")).where("n > 1")
    multi = classes.join(heads, "class_id").select("id", "class_id", "first")
    doc_id = F.when(F.col("doc") < LAST, F.col("doc")).alias("doc_id")
    where = long.select("id", "doc", "row", "line_no", "n").join(multi, "id", "left").select(
        doc_id, "row", "line_no", F.col("n").alias("chars"), F.coalesce("class_id", "id").alias("class_id"),
        F.col("first").isNotNull().alias("linked"),
        (F.col("first").isNull() | (F.col("first") == F.struct("doc", "row", "line_no"))).alias("kept"))
    short = lines.where(F.col("n") < MIN_CHARS).select(
        doc_id, "row", "line_no", F.col("n").alias("chars"), F.lit(None).cast("long").alias("class_id"),
        F.lit(False).alias("linked"), F.lit(True).alias("kept"))
    return where.unionByName(short)


def dedup_lines(docs: DataFrame, tau: int = TAU, id_col: str = "doc_id", text_col: str = "text",
                size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` without their repeated lines: the same columns, ``text_col`` holding the
    kept lines in order and ``size_col`` (if there) its code points. A row that loses all
    of its lines goes; empty and null texts stay as they are."""
    scratch = Scratch(docs.sparkSession, "linededup")
    row, cut, rest = (next(n for n in (f"{x}{'_' * k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns) for x in ("row", "cut", "rest"))
    gone = line_marks(docs, tau, id_col, text_col, scratch).where("NOT kept").groupBy(F.col("row").alias(row)).agg(
        F.collect_set("line_no").alias(cut))
    both = docs.withColumn(row, row_hash(id_col, text_col)).join(gone, row, "left")
    left = F.filter(F.split(F.col(text_col).cast("string"), "\n"), lambda x, i: ~F.array_contains(F.col(cut), i))
    both = let(both, **{rest: F.when(F.col(cut).isNotNull(), left)}).where(F.col(cut).isNull() | (F.size(rest) > 0))
    text = F.when(F.col(cut).isNull(), F.col(text_col)).otherwise(F.array_join(rest, "\n"))
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(text.alias(c))
        elif c == size_col:
            out.append(F.when(F.col(cut).isNull(), F.col(c)).otherwise(F.length(text)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, linked lines, dropped lines, code points of the kept lines and
    the classes of its linked lines."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    # rows equal in id and text have each line as often as they are there
    per = line_marks(docs).groupBy("row").agg(
        *[F.expr(f"{x} DIV count_if(line_no = 0)").alias(n) for n, x in (
            ("n_lines", "count(*)"), ("n_linked", "count_if(linked)"), ("n_dropped", "count_if(NOT kept)"), ("kept_chars", "sum(IF(kept, chars, 0))"))],
        F.sort_array(F.collect_set(F.when(F.col("linked"), F.col("class_id")))).alias("line_classes"))
    out = docs.select("doc_id", row_hash("doc_id", "text").alias("row")).join(per, "row", "left")
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_linked", "n_dropped", "kept_chars")],
                      F.coalesce("line_classes", F.array().cast("array<bigint>")).alias("line_classes"))
