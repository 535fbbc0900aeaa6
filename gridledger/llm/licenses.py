"""License notices by diagonal voting, in DataFrame functions.

All word k-grams of a text are hashed and joined to the positions of the same hash in the
templates. A match votes for its diagonal: the k-gram's place in the text less its place in
the template. Words that run along a template vote for one diagonal, an inserted or missing
word moves the votes to a neighbouring one, so each diagonal of most votes is merged with its
neighbours. What the merged votes cover is verified against the template: the words that tell
one license from another have to be those of the template.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.session import Workspace

#: Words of a k-gram, diagonals this far apart still merge, part of a template's k-grams that
#: has to be found.
GRAM, SHIFT, COVER = 2, 3, 0.8

#: Words that tell licenses apart, by family. A notice with words of a family has to be found with
#: these and without the others. Its numbers have to follow the words they follow in the template.
TELLING = (
    ("gnu", "lesser", "library", "affero"),
    ("cc", "nc", "sa", "nd"),
    ("commons", "sharealike", "noncommercial", "noderivs", "noderivatives"),
    ("mozilla", "netscape"),
    ("apache",), ("mit",), ("cc0",),
)

#: Phrases that count word for word. Results carry the labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Notices that may differ in a word. Public wording of the licenses.
NOTICES = {
    "apache-2.0": ("licensed under the apache license version 2 0",),
    "gpl-3.0": ("licensed under the gnu general public license version 3",),
    "gpl-2.0": ("licensed under the gnu general public license version 2",),
    "lgpl": (
        "gnu lesser general public license as published by the free software foundation",
        "gnu library general public license as published by the free software foundation",
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "released under the mit license",
    ),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0",),
    "cc-by-nc": ("licensed under cc by nc 4 0",),
    "cc-by-sa": (
        "licensed under cc by sa 4 0",
        "licensed under the creative commons attribution sharealike license",
    ),
    "cc0": ("dedicated to the public domain under the cc0 1 0 universal",),
}
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _templates(docs: DataFrame, phrases: Mapping[str, str], notices: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row for each k-gram of each template; as many as the given wording has words, so it may be broadcast."""
    rows = []
    texts = [(label, text, True) for text, label in phrases.items()]
    texts += [(label, text, False) for label, each in notices.items() for text in each]
    for template, (label, text, exact) in enumerate(texts):
        words = re.findall(_WORD, text)
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text}")
        marks = _marks(words)
        rows += [(template, label, exact, i, len(words), words[i : i + GRAM], *marks) for i in range(len(words) - GRAM + 1)]
    return docs.sparkSession.createDataFrame(
        rows, "template int, label string, exact boolean, at int, width int, gram array<string>, "
        "must array<array<int>>, bars array<string>"
    )


def _marks(words: Sequence[str]) -> tuple[list[list[int]], list[str]]:
    """For each telling word of a template the k-grams of which one has to be found, and the words that can't be in its span."""
    own = [family for family in TELLING if {*family} & {*words}]
    last = len(words) - GRAM
    must = []
    for i, word in enumerate(words):
        if word.isdigit():
            must.append([max(0, i - GRAM + 1)])
        elif any(word in family for family in own):
            must.append([j for j in range(i - GRAM + 1, i + 1) if 0 <= j <= last])
    return must, sorted({w for family in own for w in family} - {*words})


def _hash(words: Column, i: Column) -> Column:
    return F.xxhash64(*(F.get(words, i + k) for k in range(GRAM)))


def scan_licenses(
    docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",), *,
    phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, Sequence[str]] = NOTICES, space: Workspace | None = None,
) -> DataFrame:
    """The columns ``keep`` with ``n_words`` and ``places``, for every row.

    ``places`` has (first, end, label, exact, cover) for each phrase found word for word and
    each notice of which at least ``COVER`` of the k-grams stand near one diagonal, all that
    tells it from other licenses (``TELLING``, numbers) among them, and no word of theirs in
    between; places are words from 0, ends exclusive, sorted. Words are lower-cased runs of
    letters, digits and characters beyond ASCII.

    A null or empty text has no words and no places. Rows that repeat an id or a text stay
    rows of their own: rows are numbered in the first written table, which keeps only the
    k-grams that some template has. Other columns aren't read. No rows give no rows.
    """
    spark, space = docs.sparkSession, space or Workspace(docs.sparkSession)
    templates = _templates(docs, phrases, notices).withColumn("hash", _hash(F.col("gram"), F.lit(0)))
    marks = templates.select("template", "must", "bars").distinct()
    telling = [w for family in TELLING for w in family]
    hashes = [r.hash for r in templates.select("hash").distinct().collect()]
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), F.lit(_WORD), F.lit(0))
    rows = docs.select(F.struct(*(F.col(c) for c in keep)).alias("kept"), words.alias("words"))

    def before(i: Column) -> Column:
        """Telling words before a k-gram, as far back as merged diagonals can be apart."""
        low = F.greatest(i - 2 * SHIFT, F.lit(0))
        near = F.transform(F.slice("words", low + 1, i - low), lambda w, k: F.struct((low + k).alias("at"), w.alias("word")))
        return F.filter(near, lambda x: x["word"].isin(telling))

    known = F.transform("words", lambda w, i: F.when(
        _hash(F.col("words"), i).isin(hashes),
        F.struct(i.alias("at"), F.slice("words", i + 1, GRAM).alias("gram"), before(i).alias("before"))))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "kept", F.size("words").cast("long").alias("n_words"),
        F.filter(known, lambda x: x.isNotNull()).alias("grams"))
    rows = space.stage(rows, "rows")

    found = rows.select("row", F.explode("grams").alias("g")).select(
        "row", F.col("g.at").alias("place"), F.col("g.gram").alias("found"), F.col("g.before").alias("before"),
        _hash(F.col("g.gram"), F.lit(0)).alias("hash"))
    votes = found.join(F.broadcast(templates), "hash").where("found = gram").withColumn("diagonal", F.col("place") - F.col("at"))
    key = ["row", "template", "label", "exact", "width"]
    lines = votes.groupBy(*key, "diagonal").agg(
        F.collect_set("at").alias("ats"), F.min("place").alias("first"), (F.max("place") + GRAM).alias("end"),
        F.array_distinct(F.flatten(F.collect_list("before"))).alias("before"))
    whole = F.size("ats") == F.col("width") - (GRAM - 1)
    phrase = lines.where(F.col("exact") & whole).select("row", "label", "exact", "first", "end", F.lit(1.0).alias("cover"))

    near = Window.partitionBy(*key).orderBy("diagonal").rangeBetween(-SHIFT, SHIFT)
    own = F.struct(F.size("ats").alias("votes"), (-F.col("diagonal")).alias("diagonal"))
    merged = (
        lines.where(~F.col("exact"))
        .withColumns({
            "hits": F.array_distinct(F.flatten(F.collect_list("ats").over(near))), "leads": F.max(own).over(near) == own,
            "before": F.flatten(F.collect_list("before").over(near)),
            "first": F.min("first").over(near), "end": F.max("end").over(near)})
        .withColumn("cover", F.size("hits") / (F.col("width") - (GRAM - 1)))
        .where(F.col("leads") & (F.col("cover") >= COVER))
    )
    # One row a template.
    merged = merged.join(F.broadcast(marks), "template").where(
        F.forall("must", lambda m: F.arrays_overlap(m, "hits"))
        & ~F.exists("before", lambda x: (x["at"] >= F.col("first")) & F.array_contains("bars", x["word"])))
    places = phrase.unionByName(merged.select(*phrase.columns)).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("first", "end", "label", "exact", "cover"))).alias("places"))
    places = space.stage(places, "places")
    empty = F.expr(f"cast(array() as {places.schema['places'].dataType.simpleString()})")
    out = rows.drop("grams").join(places, "row", "left")
    return out.select("kept.*", "n_words", F.coalesce("places", empty).alias("places"))
