import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from gaugeflow.llm import suffix_index
from gaugeflow.llm import text as T
from gaugeflow.llm.suffix_index import Marker, SuffixFamily, _merge_spans, _ordered, remove_repeats

LENGTH = 12


def brute(docs, length=LENGTH):
    """Rows that share an id are one document laid over itself; a null id comes last."""
    first = {}
    order = lambda d: float("inf") if d is None else d
    for doc, text in docs:
        raw = (text or "").encode()
        for s in range(len(raw) - length + 1):
            at = (order(doc), s)
            first[raw[s:s + length]] = min(first.get(raw[s:s + length], at), at)
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for s in range(len(raw) - length + 1):
            if first[raw[s:s + length]] < (order(doc), s):
                gone[s:s + length] = True
        gone = gone[:len(raw)]
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    part = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    parts = [part(rng.randrange(5, 60)) for _ in range(12)] + ["x" * 50, "abab" * 12]
    docs = [(i, "".join(rng.choice(parts) + part(rng.randrange(0, 6)) for _ in range(rng.randrange(5))))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, "short"), (103, parts[0] * 300), (7, docs[7][1]),
             (8, "another text under a known id " + parts[1]), (None, docs[3][1]), (None, parts[2] * 2)]
    rng.shuffle(docs)
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "k", 1, 2) for d, t in docs],
                                 "doc_id long, text string, key string, start int, bucket int").repartition(5)


@pytest.mark.parametrize("hot, batches", [(4096, 4), (3, 4), (3, 1), (40, 3)])
def test_matches_brute_force(spark, hot, batches):
    docs = corpus(hot + batches)
    got = remove_repeats(frame(spark, docs), LENGTH, 4, batches, hot, bucket_bytes=500)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)


def test_production_lengths(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(60))
    docs = [(i, " ".join(word() for _ in range(rng.randrange(80))) + (f" {passage} " if i % 3 else "")
             + word()) for i in range(30)]
    docs += [(50, docs[4][1]), (51, passage[:100]), (52, passage[:99])]
    got = remove_repeats(frame(spark, docs)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, 100)


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [(1, "a")]).limit(0)).count() == 0
    only = remove_repeats(frame(spark, [(1, None), (2, "")])).collect()
    assert {(r.n_bytes, r.n_removed, r.n_spans) for r in only} == {(0, 0, 0)}


def test_levels_merge_geometrically(spark):
    ordered = _ordered(frame(spark, [(i, f"document number {i} with some text of its own") for i in range(20)]))
    family = SuffixFamily(spark, 4, LENGTH, 4)
    ranks, seen = [], []
    for i in range(5):
        seen.append(family.add(ordered.where(f"doc >= {4 * i} AND doc < {4 * i + 4}")).count())
        ranks.append([rank for rank, _ in family.levels])
    assert ranks == [[0], [1], [1, 0], [2], [2, 0]] and all(seen[1:])
    assert spark.catalog.tableExists(family.levels[0][1])
    names = [name for _, name in family.levels]
    family.drop()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_an_error_leaves_no_table(spark, monkeypatch):
    def fail(*_):
        raise RuntimeError("no merge")
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(suffix_index, "_merger", fail)
    docs = [(i, f"document number {i} with some text of its own") for i in range(20)]
    with pytest.raises(RuntimeError, match="no merge"):
        remove_repeats(frame(spark, docs)).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_levels_lie_in_the_shared_folder(spark):
    family = SuffixFamily(spark, 4, LENGTH, 4)
    family.add(_ordered(frame(spark, [(1, "some text of its own, long enough")])))
    where = spark.sql(f"DESCRIBE EXTENDED {family.levels[0][1]}").where("col_name = 'Location'").first()[1]
    assert spark.conf.get("spark.checkpoint.dir") in where
    family.drop()
    with pytest.raises(Exception):
        spark.read.parquet(where).count()


def test_scans_of_levels_need_no_exchange(spark):
    ordered = _ordered(frame(spark, [(i, f"document number {i} with some text") for i in range(8)]))
    family = SuffixFamily(spark, 4, LENGTH, 4)
    family.add(ordered.where("doc < 4"))
    family.add(ordered.where("doc >= 4"))
    family.add(ordered)
    plan = family._against(family.levels[0][1], family.levels[1][1])._jdf.queryExecution().executedPlan().toString()
    family.drop()
    assert "Exchange" not in plan


def test_equal_strings_mark_equal_suffixes():
    rng = random.Random(2)
    text = "".join(rng.choice("abc") for _ in range(400))
    marker = Marker(LENGTH, 4)
    seen = {}
    for shift in ("", "zz", "abcabc"):
        raw = shift + text
        runs = marker.runs(next(T.blocks(pa.array([raw]))))
        for key, start, strings in zip(runs.key, runs.start, runs.strings):
            for s in range(start, start + strings):
                assert seen.setdefault(raw[s:s + LENGTH], key) == key
        assert sum(runs.strings) == len(raw) - LENGTH + 1


def test_spans_join_where_they_touch():
    cols = [np.array(x) for x in ([1, 1, 1, 2, 1], [0, 0, 0, 0, 5], [10, 0, 25, 3, 9], [20, 10, 30, 4, 12])]
    assert [c.tolist() for c in _merge_spans(*cols)] == [[1, 1, 1, 2], [0, 0, 5, 0], [0, 25, 9, 3], [20, 30, 12, 4]]
