"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text becomes a vector of hashed words (square root of each bucket's share of
the words), structure statistics and its size, the only metadata used. The model
adds to a linear term every pairwise interaction <v_i, v_j> x_i x_j of low rank;
all pairs are scored in linear time by the identity
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

It is fitted on at most SAMPLE_ROWS labelled rows outside the held-out fold.
Documents are scored in one pass without a shuffle; the model of a few thousand
numbers travels with the tasks. Null and empty texts have no words and are scored
from the rest; without labels of both kinds every score is the share of good
labels (0 if there are none). Columns named like a result are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import text as T
from gaugeflow.llm.features import fold, labelled_sample, labelled_texts, structure
from gaugeflow.session import materialize

#: Labelled rows for fitting, at most; hashed buckets; rank of the interactions.
SAMPLE_ROWS, BUCKETS, RANK = 8_000, 512, 8
STEPS, STEP_SIZE, PENALTY = 80, 0.05, 1e-4


def vectors(block: T.Block, buckets: int = BUCKETS) -> np.ndarray:
    """One feature vector per text: hashed words, then structure and size."""
    found = T.words(block)
    count = np.diff(found.offsets)
    rows = np.repeat(np.arange(block.rows), count)
    cell = rows * buckets + (found.hashes % np.uint64(buckets)).astype(np.int64)
    hashed = np.bincount(cell, minlength=block.rows * buckets).reshape(block.rows, buckets)
    hashed = np.sqrt(hashed / np.maximum(count, 1)[:, None])
    shape = structure(block, found)
    size = np.log1p(np.diff(block.offsets)) / 16
    return np.column_stack([hashed, *shape.values(), size])


class FactorisationMachine:
    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray) -> None:
        self.bias, self.linear, self.factors = bias, linear, factors

    def scores(self, x: np.ndarray) -> np.ndarray:
        summed = x @ self.factors
        squares = (x * x) @ (self.factors * self.factors)
        raw = self.bias + x @ self.linear + 0.5 * (summed * summed - squares).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def train(documents: DataFrame, labels: DataFrame,
          rows: int = SAMPLE_ROWS) -> FactorisationMachine | float:
    """Fit on at most `rows` labelled documents; without both labels, the share of good ones."""
    texts = labelled_texts(documents, labelled_sample(labels, "quality", rows))

    def run(batches):
        for batch in batches:
            for block in T.blocks(batch.column(1)):
                yield pa.record_batch(
                    [batch.column(0).slice(block.first, block.rows),
                     pa.array(list(vectors(block)), pa.list_(pa.float64()))],
                    names=["label", "features"])

    sample = materialize(texts.select("label", "text")
                         .mapInArrow(run, "label double, features array<double>"), "quality-sample")
    kinds = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return float(next(iter(kinds), 0.0))
    fitted = FMClassifier(
        featuresCol="vector", labelCol="label", factorSize=RANK, maxIter=STEPS,
        stepSize=STEP_SIZE, regParam=PENALTY, initStd=0.05, seed=7).fit(
        sample.withColumn("vector", array_to_vector("features")).coalesce(6))
    return FactorisationMachine(fitted.intercept, fitted.linear.toArray(),
                                fitted.factors.toArray())


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.3,
                   rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every document row."""
    model = train(documents, labels, rows)

    def run(batches):
        for batch in batches:
            for block in T.blocks(batch.column(1)):
                if isinstance(model, float):
                    score = np.full(block.rows, model)
                else:
                    score = model.scores(vectors(block))
                yield pa.record_batch(
                    [batch.column(0).slice(block.first, block.rows), pa.array(score)],
                    names=["doc_id", "score"])

    return (documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, score double")
            .select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
