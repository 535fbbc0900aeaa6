"""Substring dedup by hashing of lines and sentences.

A text's units are its lines, and the sentences of lines that hold several, so that a passage
copied into the middle of a paragraph is found too. A unit is normalised (lower case, words
joined by one space) and its digest grouped over all texts; the earliest ranked occurrence
stays. Of the other occurrences, neighbours in one text are merged, and runs of enough words
go. Offsets are those of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.session import Workspace

#: Words that repeated neighbours need together to count as a passage; with 1 every repeated unit counts.
MIN_RUN_WORDS = 20
#: Where a unit may end: a line feed, or white space after a mark that ends a sentence.
_END = re.compile(r"\n|(?<=[.!?])[ \t\r]+")


def units(text: str | None) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Number, start, end (code points, end exclusive), words and digest of each unit that has a word."""
    text, number, start = text or "", 0, 0
    for end, following in [*((m.start(), m.end()) for m in _END.finditer(text)), (len(text), 0)]:
        words = text[start:end].lower().split()
        if words:
            yield number, start, end, len(words), hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
            number += 1
        start = following


def _units_of(rows: DataFrame) -> DataFrame:
    """Units of rows with columns row, id and text."""
    names = ["row", "id", "unit", "start", "end", "n_words", "digest"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for row, i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for unit in units(text.as_py()):
                    for column, value in zip(columns, (row, i, *unit), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return rows.mapInArrow(each, "row long, id long, unit int, start int, end int, n_words int, digest binary")


def _removals(rows: DataFrame, min_run_words: int, space: Workspace) -> DataFrame:
    """Units to remove: row, id, unit, start, end, n_words and kept, the occurrence that stays."""
    found = space.stage(_units_of(rows), "units")
    rank = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row", "unit", "start")
    first = found.groupBy("digest").agg(F.min(rank).alias("kept"), F.count("*").alias("times")).where("times > 1")
    first = space.stage(first.select("digest", "kept"), "first")
    own = (F.col("row") == F.col("kept.row")) & (F.col("unit") == F.col("kept.unit"))
    others = found.join(first, "digest").where(~own).select("row", "id", "unit", "start", "end", "n_words", "kept")
    # Units of one text only: neighbours have numbers that follow each other.
    text = Window.partitionBy("row").orderBy("unit")
    others = others.withColumn("run", F.col("unit") - F.row_number().over(text))
    run = Window.partitionBy("row", "run")
    return others.withColumn("run_words", F.sum("n_words").over(run)).where(F.col("run_words") >= min_run_words).drop("run")


def repeated_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_run_words: int = MIN_RUN_WORDS,
    space: Workspace | None = None,
) -> DataFrame:
    """One row for each unit to remove: ``id_col``, ``unit``, ``start``, ``end``, ``n_words``, ``run_words`` (words of
    the run of repeated neighbours it belongs to) and the occurrence that stays, ``kept_<id_col>``,
    ``kept_unit`` and ``kept_start``.

    Occurrences rank by id, null ids last, then by row (in the order Spark reads them) and place
    in the text. A repeated unit stays all the same if it and its repeated neighbours have fewer
    than ``min_run_words`` words; 1 removes every repeated unit. A null or empty text has no
    units. Rows that repeat an id, or a null id, are texts of their own: of equal ones the first
    stays whole. Other columns aren't read. No rows give no rows.

    Digests have 128 bits. Copies are counted before the shuffle, so a unit that a third of all
    texts hold costs each task one row; the way back to its occurrences is a skewed join of two
    written tables, which Spark splits. A window holds the repeated units of one text.
    """
    space = space or Workspace(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"))
    return _removals(rows, min_run_words, space).select(
        F.col("id").alias(id_col), "unit", "start", "end", "n_words", "run_words", F.col("kept.id").alias(f"kept_{id_col}"),
        F.col("kept.unit").alias("kept_unit"), F.col("kept.start").alias("kept_start"))


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans and the white space after each; what ends with a span loses the space before it."""
    out, at = "", 0
    for start, end in sorted(spans):
        out += text[at:start]
        at = end
        while at < len(text) and text[at].isspace():
            at += 1
            if text[at - 1] == "\n":
                break
    return out + text[at:] if at < len(text) else out.rstrip()


def without(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_run_words: int = MIN_RUN_WORDS,
    space: Workspace | None = None,
) -> DataFrame:
    """All rows and columns of ``docs``, with the repeated passages cut out of the texts.

    Rows are told apart by a number in a written table, so ids may repeat or be null: the first
    of equal texts stays whole, and the others become empty. A null text stays null.
    """
    space = space or Workspace(docs.sparkSession)
    numbered = space.stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col("_row").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    gone = _removals(rows, min_run_words, space).groupBy(F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("start", "end")).alias("_gone"))
    marked = numbered.join(gone, "_row", "left")
    at, spans = marked.columns.index(text_col), marked.columns.index("_gone")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if not s else cut(t, [(x["start"], x["end"]) for x in s])
                for t, s in zip(batch.column(at).to_pylist(), batch.column(spans).to_pylist(), strict=True)
            ]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return marked.mapInArrow(each, marked.schema).select(*docs.columns)
