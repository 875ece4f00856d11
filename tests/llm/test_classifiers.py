import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import quality, toxicity
from gaugeflow.llm import text as T
from gaugeflow.llm.features import structure

SF = "/root/testdata/sf0.1"
CLASHING = "doc_id long, text string, features string, score string, vector int, label int, probability int"


def frames(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(scores, labels, column):
    rows = scores.where("held_out").join(labels, "doc_id").select("predicted", F.col(column).alias("y")).collect()
    return [sum(1 for r in rows if (r.predicted, r.y) == pair) for pair in ((1, 1), (1, 0), (0, 1), (0, 0))]


def test_toxicity_on_the_held_out_fold(spark):
    documents, labels = frames(spark)
    scores = toxicity.toxicity_scores(documents, labels)
    hit, false, missed, clear = held_out(scores, labels, "toxic")
    assert hit / (hit + missed) > 0.85 and false / (false + clear) < 0.01
    low, high, n = scores.agg(F.min("score"), F.max("score"), F.count("score")).first()
    assert 0 <= low <= high <= 1 and n == documents.count()


def test_quality_on_the_held_out_fold(spark):
    documents, labels = frames(spark)
    scores = quality.quality_scores(documents, labels)
    hit, false, missed, clear = held_out(scores, labels, "quality")
    assert hit / (hit + missed) > 0.99 and false / (false + clear) < 0.1
    assert scores.where("score IS NULL OR score < 0 OR score > 1").count() == 0


def odd(spark):
    rows = [(1, None), (2, ""), (3, "word " * 60_000), (3, "word " * 60_000), (None, "a"), (4, "\x00\n\t")]
    return spark.createDataFrame([(d, t, "f", "s", 1, 2, 3) for d, t in rows], CLASHING)


@pytest.mark.parametrize("scorer, column", [(toxicity.toxicity_scores, "toxic"),
                                            (quality.quality_scores, "quality")])
def test_without_labels_of_both_kinds(spark, scorer, column):
    schema = f"doc_id long, {column} int"
    documents = odd(spark)
    for rows, score in (([], 0.0), ([(1, None), (None, 1), (4, 3)], 0.0), ([(2, 1), (4, 1)], None)):
        got = scorer(documents, spark.createDataFrame(rows, schema)).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert score is None or {r.score for r in got} == {score}
    assert scorer(documents.limit(0), spark.createDataFrame([], schema)).count() == 0


def test_odd_texts_and_extra_columns_with_a_model(spark):
    documents, labels = frames(spark)
    model = toxicity.train(documents, labels, rows=1500)
    rows = odd(spark)
    scored = model.scored(rows, "score")
    assert [c for c in scored.columns if c != "score"] == [c for c in rows.columns if c != "score"]
    got = scored.collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert got[2].score == got[3].score and got[0].score == got[1].score
    fitted = quality.train(documents, labels, rows=800)
    x = np.concatenate([quality.vectors(b) for b in T.blocks(pa.array([None, "", "a b", "!!"], pa.string()))])
    assert np.isfinite(fitted.scores(x)).all()


def test_factorisation_identity():
    rng = np.random.default_rng(2)
    model = quality.FactorisationMachine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    x = rng.random((4, 6))
    raw = [0.3 + row @ model.linear + sum(
        model.factors[i] @ model.factors[j] * row[i] * row[j] for i in range(6) for j in range(i))
        for row in x]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-np.array(raw))))


def test_features_see_lexicon_distance_and_disguise():
    column = pa.array(["You are an idiot.", "An idiot, and then seven more words until somebody meets you",
                       "such an id1ot and m*ron", "Fine weather", ""])
    block = next(T.blocks(column))
    x = toxicity.features(block, np.zeros(0, np.uint64))
    assert x[0, 0] > 0 and x[0, 7] > 0 and x[1, 0] > 0 and x[1, 7] == 0
    assert x[2, 0] == 0 and x[2, 8] > 0 and not x[3, :9].any() and not x[4, :9].any()
    shape = structure(block, T.words(block))
    assert all(len(v) == 5 and np.isfinite(v).all() for v in shape.values())
