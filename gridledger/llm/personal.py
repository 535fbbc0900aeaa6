"""Personal data: fixed shapes as seeds, and contexts learnt from them, in DataFrame functions.

Seeds are e-mail addresses, IP addresses, card and phone numbers of a known shape. The word
before and the word after a seed are lexical patterns. Patterns and the identifier-like
strings they surround form a graph; scores pass from seeds to patterns and from patterns to
strings in rounds of joins. Strings of no known shape that stand in patterns of high
confidence are found that way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.session import Workspace

KINDS = ("email", "ip", "card", "phone")
#: The shapes as linear-time patterns. Possessive loops keep Java's matcher from recursing; a
#: look-behind lets a match start only where a run of its characters starts (for e-mail: or
#: where the former match ended), which is where the leftmost match starts in any case.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SHAPES = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain for a shape to be looked for.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: Runs of words with a digit or an at sign, joined by single spaces.
_STRINGS = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]*+[0-9@]\S*+)*+"
#: Rounds of scoring, confidence a pattern needs, seeds it needs, characters of a context word.
ROUNDS, CONFIDENCE, SEEDS, CONTEXT = 3, 0.8, 3, 40


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    ones = F.filter(F.split(F.reverse(_digits(s)), ""), lambda c: c != "")
    worth = F.transform(ones, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, s: Column) -> Column:
    """The check a match of a shape has to pass."""
    if kind == "ip":
        return s.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return _luhn(s)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _placed(pieces: Column, hits: Column, made) -> Column:
    """``made(start, end, i)`` for each match, from the text between matches and the matches.

    Offsets are code points. ``pieces`` has one element more than ``hits``.
    """
    steps = F.transform(hits, lambda h, i: F.struct(
        F.char_length(F.get(pieces, i)).alias("gap"), F.char_length(h).alias("width")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"))
    walked = F.aggregate(steps, start, lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["width"]).alias("at"),
        F.array_append(acc["out"], F.struct(
            (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["width"]).alias("end"))).alias("out"),
    ))
    return F.transform(walked["out"], lambda s, i: made(s["start"], s["end"], i))


def _span(start: Column, kind: Column, end: Column) -> Column:
    """A span sorts by its start, then by its kind's place in ``KINDS``."""
    return F.struct(start.alias("start"), kind.cast("int").alias("kind"), end.alias("end"))


def _seeds(df: DataFrame, text: str) -> DataFrame:
    """Adds ``base``: the sorted spans of the fixed shapes."""
    none = F.expr("cast(array() as array<string>)")
    for kind, shape in SHAPES.items():
        has = F.contains(F.col(text), F.lit(_NEEDS[kind])) & F.col(text).rlike("[0-9]" if kind != "email" else "@")
        df = df.withColumns({
            f"_{kind}_hits": F.when(has, F.regexp_extract_all(F.col(text), F.lit(shape), F.lit(0))).otherwise(none),
        })
        df = df.withColumn(
            f"_{kind}_pieces", F.when(F.size(f"_{kind}_hits") > 0, F.split(F.col(text), shape, -1)).otherwise(none))
    spans = []
    for k, kind in enumerate(KINDS):
        hits, pieces = F.col(f"_{kind}_hits"), F.col(f"_{kind}_pieces")
        found = _placed(pieces, hits, lambda a, b, i, hits=hits, k=k, kind=kind: F.struct(
            _span(a, F.lit(k), b).alias("span"), _holds(kind, F.get(hits, i)).alias("ok")))
        spans.append(F.transform(F.filter(found, lambda x: x["ok"]), lambda x: x["span"]))
    drop = [f"_{kind}_{x}" for kind in KINDS for x in ("hits", "pieces")]
    return df.withColumn("base", F.array_sort(F.concat(*spans))).drop(*drop)


def _contexts(df: DataFrame, text: str) -> DataFrame:
    """Adds ``strings``: identifier-like strings with the words around them and the kind of a seed they hold, if any."""
    none = F.expr("cast(array() as array<string>)")
    df = df.withColumn("_hits", F.when(
        F.col(text).rlike("[0-9@]"), F.regexp_extract_all(F.col(text), F.lit(_STRINGS), F.lit(0))).otherwise(none))
    df = df.withColumn("_pieces", F.when(F.size("_hits") > 0, F.split(F.col(text), _STRINGS, -1)).otherwise(none))

    def made(start: Column, end: Column, i: Column) -> Column:
        inside = F.filter("base", lambda s: (s["start"] < end) & (s["end"] > start))
        before = F.regexp_extract(F.right(F.get("_pieces", i), F.lit(CONTEXT)), r"(\S+)\s*$", 1)
        after = F.regexp_extract(F.left(F.get("_pieces", i + 1), F.lit(CONTEXT)), r"^\s*(\S+)", 1)
        return F.struct(
            start.alias("start"), end.alias("end"), F.get("_hits", i).alias("text"),
            F.lower(before).alias("before"), F.lower(after).alias("after"), F.get(inside, F.lit(0))["kind"].alias("kind"))

    return df.withColumn("strings", _placed(F.col("_pieces"), F.col("_hits"), made)).drop("_hits", "_pieces")


def _score(edges: DataFrame, space: Workspace) -> DataFrame:
    """Confidence of each pattern for each kind, after ``ROUNDS`` rounds over the pattern-string graph.

    ``edges`` holds each pattern and string once, with the string's kind or null. A pattern's
    confidence is the mean of its strings' scores, with one more string of score 0. A seed
    scores 1 for its kind; any other string 1 minus the product of its patterns' doubts.
    """
    names = [f"k{k}" for k in range(len(KINDS))]
    known = space.stage(edges.groupBy("string").agg(F.max("kind").alias("kind")), "strings")
    score = known.select("string", *((F.col("kind") == k).cast("double").alias(n) for k, n in enumerate(names)))
    score = space.stage(score.na.fill(0.0), "score-0")
    for i in range(1, ROUNDS + 1):
        pattern = space.stage(
            edges.select("pattern", "string").join(score, "string").groupBy("pattern").agg(
                *((F.sum(n) / (F.count("*") + 1)).alias(n) for n in names),
                *(F.count_if(F.col(n) == 1).alias(f"seeds_{n}") for n in names)),
            f"pattern-{i}",
        )
        if i == ROUNDS:
            return pattern
        doubt = space.stage(
            edges.select("pattern", "string").join(pattern, "pattern").groupBy("string")
            .agg(*(F.sum(F.log1p(-F.col(n))).alias(n) for n in names)), f"doubt-{i}")
        score = space.stage(
            known.join(doubt, "string").select("string", *(
                F.when(F.col("kind").isNull(), 1 - F.exp(n)).otherwise((F.col("kind") == k).cast("double")).alias(n)
                for k, n in enumerate(names))),
            f"score-{i}",
        )
    raise AssertionError


def find_personal_data(
    docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",), space: Workspace | None = None
) -> DataFrame:
    """The columns ``keep`` with ``base`` and ``spans``, for every row.

    Both are arrays of (start, kind, end) sorted by start, then kind: offsets are code
    points, ends exclusive, kinds are places in ``KINDS``. ``base`` has what the fixed
    shapes and their checks find, ``spans`` also what learnt contexts find.

    A null text is empty and has no spans. Rows that repeat an id or a text stay rows of
    their own: rows are numbered in the first written table. Columns outside ``keep`` and
    ``text_col`` aren't read, so their names can't clash. No rows give no rows.
    """
    space = space or Workspace(docs.sparkSession)
    df = docs.select(
        F.struct(*(F.col(c) for c in keep)).alias("kept"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = _contexts(_seeds(df, "text"), "text").withColumn("row", F.monotonically_increasing_id())
    rows = space.stage(df.drop("text"), "rows")
    strings = rows.select("row", F.explode("strings").alias("s")).select("row", "s.*")
    strings = strings.withColumn("pattern", F.explode(F.array(
        F.concat(F.lit("before "), "before"), F.concat(F.lit("after "), "after")))).withColumnRenamed("text", "string")
    strings = strings.where(F.length(F.substring_index("pattern", " ", -1)) > 0)
    edges = space.stage(strings.groupBy("pattern", "string").agg(F.max("kind").alias("kind")), "edges")
    names = [f"k{k}" for k in range(len(KINDS))]
    trusted = _score(edges, space).select("pattern", F.explode(F.array(*(
        F.when((F.col(n) >= CONFIDENCE) & (F.col(f"seeds_{n}") >= SEEDS), F.struct(F.col(n).alias("sure"), F.lit(k).alias("kind")))
        for k, n in enumerate(names)))).alias("t")).where("t IS NOT NULL")
    best = Window.partitionBy("row", "start").orderBy(F.desc("t.sure"), "t.kind")
    new = (
        strings.where("kind IS NULL").drop("kind").join(space.stage(trusted, "trusted"), "pattern")
        .where(F.length(_digits(F.col("string"))) + 4 * F.contains("string", F.lit("@")).cast("int") >= 4)
        .withColumn("place", F.row_number().over(best)).where("place = 1")
        .groupBy("row").agg(F.collect_list(_span(F.col("start"), F.col("t.kind"), F.col("end"))).alias("new"))
    )
    joined = rows.drop("strings").join(space.stage(new, "new"), "row", "left")
    spans = F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "new")))
    return joined.select("kept.*", "base", spans.alias("spans"))


def named(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with ``<KIND>`` in place of each span; a span that starts inside a former one only widens it."""
    marks = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.aggregate(spans, start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(
            F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(marks, s["kind"])))).alias("out"),
    ), lambda acc: F.array_join(F.array_append(acc["out"], F.substr(text, acc["at"] + 1)), ""))
