"""Toxicity by non-negative positive-unlabelled learning.

The learner knows some toxic texts and many texts of which it is told nothing. With class
prior p, positives P and unlabelled U, the risk of a score f under the logistic loss l is
p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]): the second part estimates the risk on clean
texts without having any, and the bound at zero keeps it from being driven below what a risk
can be. A step that would do so climbs back instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Bounds of what the classifier is fitted on: positives, unlabelled texts, features.
POSITIVES, UNLABELLED, FEATURES = 4000, 12_000, 800
#: Part of the positives a feature must be in, and standard errors by which its log odds must differ from 0.
SUPPORT, ERRORS = 0.002, 2.0
#: Letters of the word beginnings that are features beside the words.
STEMS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """Distinct words of a text, lower-cased, and their beginnings."""
    words = set(_WORD.findall((text or "").lower()))
    return words.union(*({f"{w[:n]}*" for w in words if len(w) > n} for n in STEMS))


@dataclass(frozen=True)
class Model:
    weight: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + sum(map(self.weight.__getitem__, features(text) & self.weight.keys()))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit_nnpu(
    x: np.ndarray, positive: np.ndarray, prior: float, *, epochs: int = 300, rate: float = 0.05, decay: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear score under the non-negative risk, by Adam on all rows.

    ``positive`` marks the confirmed rows, all others are unlabelled.
    """
    theta = np.zeros(x.shape[1] + 1)
    theta[-1] = np.log(prior / (1 - prior))
    x = x.astype(np.float32)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    xp, xu = x[positive], x[~positive]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    linear = lambda rows: rows @ theta[:-1].astype(np.float32) + theta[-1]
    gradient = lambda rows, slope: np.append(slope.astype(np.float32) @ rows, slope.sum()) / len(rows)
    for t in range(1, epochs + 1):
        zp, zu = linear(xp), linear(xu)
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        clean_slope = gradient(xu, sigmoid(zu)) - prior * gradient(xp, sigmoid(zp))
        # Logistic loss of a positive: its slope is sigmoid(z) - 1.
        g = prior * gradient(xp, sigmoid(zp) - 1) + clean_slope if clean >= 0 else -clean_slope
        g[:-1] += decay * theta[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _vocabulary(rows: DataFrame, positives: int, unlabelled: int, most: int) -> list[str]:
    """The features that tell positives from unlabelled texts best, ``most`` at most."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sign = [], []
            for text, positive in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = features(text.as_py())
                names += found
                sign += [positive] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sign, pa.bool_())], ["name", "positive"])

    p, u = F.count_if("positive"), F.count_if(~F.col("positive"))
    rate_p, rate_u = (p + 0.5) / (positives + 1), (u + 0.5) / (unlabelled + 1)
    tells = (
        rows.mapInArrow(each, "name string, positive boolean").groupBy("name")
        .agg(p.alias("p"), u.alias("u"), (F.abs(F.log(rate_p / rate_u)) / F.sqrt(1 / (p + 0.5) + 1 / (u + 0.5))).alias("tells"))
        .where((F.col("p") >= max(2, SUPPORT * positives)) & (F.col("tells") >= ERRORS))
    )
    return [r.name for r in tells.orderBy(F.desc("tells"), "name").select("name").limit(most).collect()]


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", positives: int = POSITIVES,
        unlabelled: int = UNLABELLED, most: int = FEATURES) -> Model:
    """Fit on at most ``positives`` toxic texts and ``unlabelled`` texts taken from the labelled ones.

    ``labels`` has ``id`` and ``toxic`` and says which rows may be learnt from. The class
    prior is the part of toxic rows among them; which of the unlabelled texts are toxic is
    not used. An id that is labelled both ways counts as toxic. Without a toxic text every
    score is the prior of 1 in 1000.
    """
    known = labels.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    total, toxic = known.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    if not toxic:
        return Model({}, float(np.log(0.001 / 0.999)))
    prior = min(toxic / total, 0.5)
    mixed = F.xxhash64("id")
    chosen = known.where("toxic = 1").orderBy(mixed, "id").limit(positives).select("id", F.lit(True).alias("positive"))
    chosen = chosen.unionByName(
        known.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(unlabelled).select("id", F.lit(False).alias("positive")))
    # At most positives + unlabelled ids.
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = text.join(F.broadcast(chosen), "id").select("text", "positive")
    counts = {r.positive: r["count"] for r in rows.groupBy("positive").count().collect()}
    if not counts.get(True) or not counts.get(False):
        return Model({}, float(np.log(prior / (1 - prior))))
    names = _vocabulary(rows, counts[True], counts[False], most)
    place = {n: i for i, n in enumerate(names)}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [sorted(place[n] for n in features(t.as_py()) & place.keys()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.int32())), batch.column(1)], ["has", "positive"])

    sample = rows.mapInArrow(each, "has array<int>, positive boolean").toArrow()
    x = np.zeros((len(sample), len(names)), np.float32)
    has = sample["has"].combine_chunks()
    x[np.repeat(np.arange(len(sample)), has.value_lengths().to_numpy()), has.flatten().to_numpy()] = 1
    weight, bias = fit_nnpu(x, sample["positive"].to_numpy(), prior)
    return Model(dict(zip(names, weight.tolist(), strict=True)), bias)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with a score from 0 to 1; higher means likelier toxic.

    A null or empty text scores what the bias alone gives. A column that has the new name is
    replaced. Whole texts are read; the model is bounded by the features it may have.
    """
    kept = [c for c in docs.columns if c != name]
    docs = docs.select(*kept)
    at = docs.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([model.score(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    schema = StructType([*docs.schema, StructField(name, DoubleType())])
    return docs.mapInArrow(each, schema)
