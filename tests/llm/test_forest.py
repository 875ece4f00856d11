import random

import numpy as np
import pytest
from gaugeflow.llm import minhash_forest
from gaugeflow.llm.components import connected_components
from gaugeflow.llm.minhash_forest import jaccard_join, one_per_class, prefix_depth, sketch_groups
from test_text_kernels import plain_words


def grams(text):
    w = plain_words(text)
    n = min(len(w), 5)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def brute(docs):
    """(doc_id, class_id, copy_id, n_copies, n_links) by comparing all pairs."""
    sets = [grams(t) for _, t in docs]
    distinct = [s for s in dict.fromkeys(sets) if s]
    close = {s: [o for o in distinct if o != s and 5 * len(s & o) >= 4 * len(s | o)] for s in distinct}
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    out = []
    for (doc, _), s in zip(docs, sets):
        if not s:
            out.append((doc, doc, doc, 1, 0))
            continue
        group, todo = {s}, [s]
        while todo:
            new = [o for o in close[todo.pop()] if o not in group]
            group |= set(new)
            todo += new
        out.append((doc, low(d for (d, _), o in zip(docs, sets) if o in group),
                    low(d for (d, _), o in zip(docs, sets) if o == s), sets.count(s), len(close[s])))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    shared = [word() for _ in range(30)]
    docs = []
    for base in range(12):
        w = [word() for _ in range(80)]
        docs.append(w)
        for change in (1, 2, 3):
            copy = list(w)
            for _ in range(change):
                copy[rng.randrange(80)] = word()
            docs.append(copy)
        docs.append(w)
    hub = [word() for _ in range(120)]
    for _ in range(60):  # many near copies of one text
        copy = list(hub)
        copy[rng.randrange(120)] = word()
        docs.append(copy)
    docs += [[word() for _ in range(20)] + shared for _ in range(30)]  # one passage in many texts
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    rng.shuffle(rows)
    return rows + [(500, None), (501, ""), (502, "..."), (503, "one two"), (504, "One, two!"),
                   (505, "solo"), (0, next(t for i, t in rows if i == 0)), (None, rows[3][1]),
                   (506, " ".join(f"w{i}" for i in range(30_000))), (507, " ".join(f"w{i}" for i in range(29_990)))]


def frame(spark, docs):
    return spark.createDataFrame([(d, t, 5, b"s", 0) for d, t in docs],
                                 "doc_id long, text string, text_key long, doc_key binary, kept int").repartition(4)


def rows_of(df):
    return sorted(((r.doc_id, r.class_id, r.copy_id, r.n_copies, r.n_links) for r in df.collect()), key=str)


def test_matches_brute_force_also_in_small_blocks(spark):
    docs = corpus()
    want = brute(docs)
    assert rows_of(jaccard_join(frame(spark, docs))) == want
    df = jaccard_join(frame(spark, docs), node_block=8, group_block=8, group_grams=2000)
    assert rows_of(df) == want
    kept = [r for r in df.collect() if r.kept]
    assert sorted(r.class_id for r in kept if r.doc_id is not None) == sorted({w[1] for w in want})


def test_one_row_of_each_class_stays(spark):
    docs = corpus()
    documents = frame(spark, docs)
    left = one_per_class(documents)
    assert left.columns == documents.columns
    classes = {w[1] for w in brute(docs)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(classes)


def test_empty_table(spark):
    documents = frame(spark, [(1, "a")]).limit(0)
    assert jaccard_join(documents).count() == 0
    assert one_per_class(documents).count() == 0


def test_null_ids_only(spark):
    docs = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "z y x w v u")]
    assert one_per_class(frame(spark, docs)).count() == 2


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_rows_that_the_join_keeps_all_stay(spark, monkeypatch, broadcast):
    monkeypatch.setattr(minhash_forest, "BROADCAST_KEYS", broadcast)
    docs = [(None, None), (None, None), (None, ""), (None, ""), (7, None), (7, None), (7, "a b c d e f"),
            (7, "a b c d e f"), (8, "a b c d e f"), (9, "--"), (9, "--"), (10, "one two"), (11, "one two three")]
    want = sum(r.kept for r in jaccard_join(frame(spark, docs)).collect())
    left = one_per_class(frame(spark, docs)).collect()
    assert len(left) == want == 11
    assert sorted((r.doc_id, r.text) for r in left if r.text and "a" in r.text) == [(7, "a b c d e f")]


@pytest.mark.parametrize("size", [1024, 2048])
def test_words_of_equal_polynomial_hash_are_different_sets(spark, size):
    word = "ab"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = [(1, word), (2, other), (3, f"{word} x"), (4, f"{other} x"), (5, word)]
    got = {r.doc_id: r.class_id for r in jaccard_join(frame(spark, docs)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_prefixes_shorten_until_the_recall_is_met():
    assert prefix_depth(0.8, 16, 5, 0.999) == 4
    assert prefix_depth(0.8, 16, 5, 0.99) == 5
    assert prefix_depth(0.5, 4, 5, 0.9999) == 1


def test_sketch_groups_are_connected():
    sketches = np.array([[1, 1, 1, 1], [9, 9, 9, 9], [1, 1, 1, 2], [3, 1, 1, 2], [9, 9, 9, 8]], np.uint8)
    assert sketch_groups(sketches, 0.75).tolist() == [0, 1, 0, 0, 1]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
