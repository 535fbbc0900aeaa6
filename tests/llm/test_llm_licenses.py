import random
import re

import messy

from gridledger.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def phrases(text):
    w = words(text)
    return sorted(
        (i, i + n, label) for phrase, label in licenses.PHRASES.items()
        for n in [len(phrase.split())] for i in range(len(w) - n + 1) if " ".join(w[i : i + n]) == phrase)


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan_licenses(df).collect()}


def test_phrases_word_for_word(spark):
    rng = random.Random(4)
    pool = ["cc", "by", "CC-BY", "all", "rights", "Reserved.", "general", "public", "license", "é", "GNU", "x"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 80))) for _ in range(200)]
    texts += ["", "cc", "cc by", "cc by cc by", "All rights reserved", "(c) ALL RIGHTS\nRESERVED!", "cc/by:cc_by", "ccby", "écc by"]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        assert got[i].n_words == len(words(t))
        assert [(p.first, p.end, p.label) for p in got[i].places if p.exact] == phrases(t), t


def test_notices_by_diagonals(spark):
    texts = [
        "foo Licensed under the Apache License, Version 2.0. bar",
        "foo licensed under the old apache license version 2 0 bar",  # a word more: two neighbouring diagonals
        "apache license version",  # too little of it
        "Licensed under CC BY-NC 4.0.",
        "licensed under the gnu general public license version 3 " * 3,
        "under the apache far away from this license version 2 0 licensed",
    ]
    got = scan(spark, texts)
    labels = {i: sorted({p.label for p in r.places}) for i, r in got.items()}
    assert labels == {
        0: ["apache-2.0"], 1: ["apache-2.0"], 2: [], 3: ["cc-by", "cc-by-nc"], 4: ["gpl", "gpl-3.0"], 5: [],
    }
    assert [(p.first, p.end, p.cover) for p in got[0].places] == [(1, 9, 1.0)]
    assert [(p.first, p.end, round(p.cover, 3)) for p in got[1].places] == [(1, 10, 0.857)]
    assert sum(p.label == "gpl-3.0" for p in got[4].places) == 3


def test_notices_that_differ_in_the_word_that_tells(spark):
    gpl = "This is licensed under the GNU {}General Public License, version {}. And more."
    published = "under the terms of the GNU {}General Public License as published by the Free Software Foundation"
    cases = [
        (gpl.format("", 3), ["gpl", "gpl-3.0"]), (gpl.format("", 2), ["gpl", "gpl-2.0"]), (gpl.format("", 1), ["gpl"]),
        (gpl.format("", "2.0"), ["gpl", "gpl-2.0"]), (gpl.format("Lesser ", 3), ["gpl"]), (gpl.format("Affero ", 3), ["gpl"]),
        ("licensed under the new gnu general public license version 3", ["gpl", "gpl-3.0"]),
        (gpl.format("", "2 or version 3"), ["gpl", "gpl-2.0", "gpl-3.0"]),
        ("The lesser affero apache. " + gpl.format("", 3), ["gpl", "gpl-3.0"]),
        (published.format(""), ["gpl"]), (published.format("Lesser "), ["gpl", "lgpl"]), (published.format("Library "), ["gpl", "lgpl"]),
        ("subject to the terms of the Mozilla Public License, v. 2.0", ["mpl-2.0"]),
        ("subject to the terms of the Mozilla Public License, v. 1.1", []),
        ("subject to the terms of the Netscape Public License, v. 2.0", []),
        ("Licensed under the Apache License, Version 2.1", []),
        ("Licensed under CC BY-NC-SA 4.0", ["cc-by"]), ("Licensed under CC BY-SA 4.0", ["cc-by", "cc-by-sa"]),
        ("licensed under the creative commons attribution noncommercial sharealike license", []),
        ("Redistribution and use of the library in source and binary forms, with or without modification, are permitted", ["bsd"]),
    ]
    got = scan(spark, [t for t, _ in cases])
    assert [(t, sorted({p.label for p in got[i].places})) for i, (t, _) in enumerate(cases)] == cases


def test_rows(spark):
    docs = messy.documents(spark)
    got = licenses.scan_licenses(docs, keep=["doc_id", "text", "row", "words", "n_chars"]).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.n_words == len(words(r.text)) and r.words == ["w"]


def test_empty(spark):
    assert licenses.scan_licenses(messy.empty(spark)).collect() == []
