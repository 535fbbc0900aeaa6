import messy
import numpy as np
from pyspark.sql import functions as F

from gridledger.llm import toxicity
from gridledger.llm.catalog import QUERIES


def test_risk_separates_with_positives_and_unlabelled_only():
    rng = np.random.default_rng(0)
    toxic = rng.random(4000) < 0.2
    x = (rng.random((4000, 12)) < 0.3).astype(np.float32)
    x[:, 0] = toxic & (rng.random(4000) < 0.9)
    x[:, 1] = toxic & (rng.random(4000) < 0.9)
    positive = toxic & (rng.random(4000) < 0.5)
    weight, bias = toxicity.fit_nnpu(x, positive, 0.2)
    hit = x @ weight + bias > 0
    assert (hit == toxic).mean() > 0.95


def test_held_out_labels(spark):
    path = "/root/testdata/sf0.01"
    got = QUERIES["op5_toxicity"](spark, path)
    labels = spark.read.parquet(f"{path}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{path}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.95
    pairs = [(a.score, b.score) for a in rows if a.toxic for b in rows if not b.toxic]
    assert sum(a > b for a, b in pairs) / len(pairs) >= 0.95


def test_messy_rows_and_labels(spark):
    docs = messy.documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (2, None), (9999, 1)], "id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_toxicity(docs, model)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    again = toxicity.fit(docs, labels)
    assert again == model


def test_without_labels_or_rows(spark):
    docs, none = messy.documents(spark), spark.createDataFrame([], "id long, toxic int")
    assert toxicity.fit(docs, none).score("anything") < 0.5
    assert toxicity.fit(messy.empty(spark), spark.createDataFrame([(1, 1), (2, 0)], "id long, toxic int")).score(None) <= 0.5
    assert toxicity.score_toxicity(messy.empty(spark), toxicity.Model({}, 0.0)).collect() == []


def test_scores_do_not_see_other_columns(spark):
    docs = messy.documents(spark)
    model = toxicity.Model({"cat": 2.0}, -1.0)
    score = lambda df: sorted((str(r.doc_id), r.score) for r in toxicity.score_toxicity(df, model).collect())
    assert score(docs) == score(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")))
