"""The pipeline against a plain version of every stage."""

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from __spark_entry__ import oracle_sql, queries
from gaugeflow.llm import bpe, pii
from pyspark.sql import functions as F
from gaugeflow.llm.queries import QUERIES
from gaugeflow.llm.toxicity import train
from test_decontamination import brute as contaminated
from test_forest import brute as classes

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in model.scored(documents).collect() if r.score < corpus_pipeline.TOXIC]
    keep = {c[1] for c in classes(rows)}
    rows = [r for r in rows if r[0] in keep]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in contaminated(rows, items) if r[5]}
    rows = [r for r in rows if r[0] not in bad]
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS),
        special_tokens={})
    want = []
    for doc, text in rows:
        for start, end, kind, canonical in reversed(pii.detect(text)):
            new = pii.surrogate(kind, canonical, 0, pii.DEFAULT_KEY)
            text = text[:start] + pii.dressed(kind, text[start:end], new) + text[end:]
        ids = reference.encode_ordinary(text)
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and 0 < len(bad) and len(keep) < documents.count()


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a clean text " * 20, "en", "s", 1, "x"), (1, "a clean text " * 20, "en", "s", 1, "x"),
         (2, None, None, None, None, None), (None, "", "en", "s", 0, "y")],
        "doc_id long, text string, lang string, source string, n_chars long, score string").coalesce(1)
    docs = docs.withColumns({c: F.lit(c) for c in (
        "toxicity", "features", "vector", "doc_key", "text_key", "kept_id", "hit_id", "text_copy", "mentions")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 3 <= out.count() <= 4
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_personal_data_on_a_cluster_without_a_key(spark, monkeypatch):
    texts = ["Mail jo.81@mail3.example.com or call +1 (017) 555-7713.", "JO.81@MAIL3.EXAMPLE.COM again", None, "none"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")

    def stage():
        return [r.text for r in corpus_pipeline.personal_data(spark, docs, SF).orderBy("doc_id").collect()]

    monkeypatch.delenv(pii.KEY_VARIABLE, raising=False)
    local = stage()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://cluster:7077")
    monkeypatch.setattr(pii, "_DRAWN", {}, raising=False)
    with pytest.warns(UserWarning, match=pii.KEY_SETTING):
        first = stage()
    mail = first[0].split()[1]
    assert first[1] == f"{mail.upper()} again" and first[2:] == [None, "none"]
    assert mail not in texts[0] and mail not in local[0]  # neither the original nor the public key's
    assert stage() == first  # one key per application
    pii._DRAWN.clear()
    with pytest.warns(UserWarning):
        assert mail not in stage()[0]
    monkeypatch.setenv(pii.KEY_VARIABLE, "of the environment")
    given = stage()
    monkeypatch.setattr(pii, "_DRAWN", {}, raising=False)
    assert stage() == given != first


def test_registration():
    names = queries()
    assert set(QUERIES) < set(names) and "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(oracle_sql()) <= set(names)
