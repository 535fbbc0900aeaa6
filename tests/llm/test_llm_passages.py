import re

import messy
import pytest
from pyspark.sql import functions as F

from gridledger.llm import catalog, passages


def pieces(text):
    """Number, start, end and words of each unit, character by character."""
    at, number, out = 0, 0, []
    while at <= len(text or ""):
        end = at
        while end < len(text) and text[end] != "\n" and not (end and text[end - 1] in ".!?" and text[end] in " \t\r"):
            end += 1
        following = end + 1
        if end < len(text) and text[end] != "\n":
            while following < len(text) and text[following] in " \t\r":
                following += 1
        words = text[at:end].lower().split()
        if words:
            out.append((number, at, end, words))
            number += 1
        at = following
    return out


def plain(rows, least):
    """Units to remove, by ranking all occurrences in a list; rows that share an id must be alike."""
    found = sorted(
        ((r.doc_id is None, r.doc_id or 0, k, unit), start, end, words)
        for k, r in enumerate(rows) for unit, start, end, words in (pieces(r.text) if r.text else [])
    )
    first, again = {}, {}
    for rank, start, end, words in found:
        line = " ".join(words)
        if line in first:
            again.setdefault(rank[:3], []).append((rank[3], start, end, len(words), *first[line]))
        else:
            first[line] = (None if rank[0] else rank[1], rank[3], start)
    out = []
    for (unnamed, i, _), units in again.items():
        runs = [[units[0]]]
        for u in units[1:]:
            if u[0] == runs[-1][-1][0] + 1:
                runs[-1].append(u)
            else:
                runs.append([u])
        for run in runs:
            n = sum(u[3] for u in run)
            out += [(None if unnamed else i, *u[:4], n, *u[4:]) for u in run if n >= least]
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [1, 20])
def test_against_a_list(spark, least):
    docs = messy.documents(spark).where("doc_id IS NULL OR doc_id <> 8")
    rows = docs.where(F.col("doc_id").isNotNull()).collect() + docs.where(F.col("doc_id").isNull()).collect()
    got = passages.repeated_passages(docs, min_run_words=least)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, least)


def test_query_over_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = catalog.QUERIES["op9_passages"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=str) == plain(docs.collect(), 20) and got


def test_passage_inside_a_paragraph_and_in_short_lines(spark):
    passage = "It was cold that day. Nobody came to the door of the old house! Was it the wind? We shall never know what it was."
    verse = "\n".join(f"line {n} of the song" for n in ("one", "two", "three", "four", "five"))
    rows = [(1, f"Start here. {passage} And so on."), (2, f"Other words. {passage}\nThe end."), (3, verse), (4, f"title\n{verse}\nlast"),
            (5, "title"), (6, "Start here. Nothing else.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    got = passages.repeated_passages(docs).collect()
    cut = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        cut.setdefault(r.doc_id, []).append(text[r.doc_id][r.start : r.end])
    assert cut == {2: re.split(r"(?<=[.!?]) ", passage), 4: verse.split("\n")}
    left = {r.doc_id: r.text for r in passages.without(docs).collect()}
    assert left == text | {2: "Other words. The end.", 4: "title\nlast"}
    # Lone repeats go with a limit of one word.
    all_gone = {r.doc_id: r.text for r in passages.without(docs, min_run_words=1).collect()}
    assert all_gone[5] == "" and all_gone[6] == "Nothing else."


def test_rows_that_repeat_ids_and_null_ids(spark):
    line = " ".join(f"w{i}" for i in range(25))
    rows = [(7, line), (7, line), (None, line), (None, None), (8, f"{line}\nrest")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, row int, unit int").coalesce(1)
    left = passages.without(docs)
    assert left.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(
        map(str, [(7, line), (7, ""), (None, ""), (None, None), (8, "rest")]))


def test_empty(spark):
    assert passages.repeated_passages(messy.empty(spark)).collect() == []
    assert passages.without(messy.empty(spark)).collect() == []
