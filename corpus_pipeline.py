"""From raw documents to token digests: one operator a stage, each on what the former kept."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.llm import bpe, mixing, personal, simhash, toxicity
from gridledger.llm.catalog import prepare, training_labels
from gridledger.session import Workspace
from gridledger.sources import read_table

#: A document goes if its toxicity score reaches this.
TOXIC = 0.5


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; it is fitted on the given documents."""
    model = toxicity.fit(docs, training_labels(prepare(spark), sf_dir))
    scored = toxicity.score_toxicity(docs, model, name="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC).drop("_toxicity")


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, that of the smallest id; without any id, one of its rows.

    Rows are told apart by a number in a written table, so of rows that repeat an id one stays too.
    """
    space = Workspace(prepare(spark))
    numbered = space.stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    # Groups are named by their smallest row number, which is never null.
    groups = simhash.near_duplicates(numbered, "_row", space=space)
    named = groups.select("_row", F.col("component_id").alias("_group")).join(numbered.select("_row", "doc_id"), "_row")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row"))
    kept = space.stage(named.groupBy("_group").agg(least.alias("least")).select(F.col("least._row").alias("_row")), "kept")
    # The list grows with the documents: it is shuffled at every size, never broadcast.
    return numbered.join(kept.hint("merge"), "_row", "left_semi").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind; n_chars follows."""
    prepare(spark)
    found = personal.find_personal_data(docs, keep=docs.columns)
    text = F.when(F.size("spans") > 0, personal.masked(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    masked = found.withColumn("text", text)
    n_chars = F.when(F.size("spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which the mixture takes them."""
    mixed = mixing.mix_sources(docs, space=Workspace(prepare(spark)))
    slot = ["mix_slot", "mix_place"]
    return mixed.repartitionByRange(*slot).sortWithinPartitions(*slot).select(*docs.columns)


def place_in(docs: DataFrame) -> DataFrame:
    """Rows read from Parquet files that Spark wrote, with ``mix_order``: how many were written before the row.

    Part files are ordered by their numbers, rows by their place in the file.
    """
    sizes = docs.select(F.col("_metadata.file_name").alias("file")).groupBy("file").count().collect()
    parts = [(*re.match(r"part-(\d+).*?(?:-c(\d+))?\.", r.file).groups("0"), r) for r in sizes]
    starts, before = [], 0
    for _, _, r in sorted(parts, key=lambda p: (int(p[0]), int(p[1]))):
        starts.append((r.file, before))
        before += r["count"]
    # One row a file.
    starts = docs.sparkSession.createDataFrame(starts, "_file string, _before long")
    placed = docs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")).join(F.broadcast(starts), "_file")
    return placed.select(*docs.columns, (F.col("_before") + F.col("_at")).alias("mix_order"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of what they decode to, with its place in the mixture's order.

    ``docs`` is read from the files of the former stage, which hold that order.
    """
    prepare(spark)
    placed = place_in(docs).withColumn("doc_id", F.struct("doc_id", "mix_order"))
    # Workers that serve this session again afterwards shouldn't hold this stage's results.
    ranks = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = bpe.digests(placed, ranks, public_tokenizers.PATTERN, lasting=False)
    rest = [c for c in found.columns if c != "doc_id"]
    return found.select(F.col("doc_id.doc_id").alias("doc_id"), *rest, F.col("doc_id.mix_order").alias("mix_order"))


STAGES = [
    ("toxicity", keep_clean),
    ("simhash", keep_distinct),
    ("personal", mask_personal_data),
    ("mixing", mix),
    ("bpe", tokens),
]

#: The classifier, the masks and the tokenizer can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each stage's rows are written before the next reads them."""
    space = Workspace(prepare(spark))
    docs = read_table(spark, sf_dir, "documents", suffix=".parquet")
    for name, stage in STAGES[:-1]:
        docs = space.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
