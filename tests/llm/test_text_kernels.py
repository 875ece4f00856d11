import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeflow.llm import text as T
from gaugeflow.llm.groups import components, sorted_groups

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8), st.integers(1, 60))
def test_words_match_a_regular_expression(texts, limit):
    got = []
    for block in T.blocks(pa.array(texts, pa.string()), limit):
        found = T.words(block)
        data = T.lower_table()[block.data].tobytes()
        for lo, hi in zip(found.offsets, found.offsets[1:]):
            got.append([data[a:b].decode() for a, b in zip(found.starts[lo:hi], found.ends[lo:hi])])
    assert got == [plain_words(t) for t in texts]


def test_hashes_depend_on_the_bytes_only():
    texts = ["alpha beta gamma", "gamma", None, "", "xx Beta", "a" * 600_000 + " alpha", "alpha"]
    seen = {}
    for block in T.blocks(pa.array(texts, pa.string()), 50):
        found = T.words(block)
        data = T.lower_table()[block.data].tobytes()
        for a, b, h in zip(found.starts, found.ends, found.hashes):
            assert seen.setdefault(data[a:b], h) == h
    assert len(set(seen.values())) == len(seen)


def test_ngrams_stay_within_rows():
    block = next(T.blocks(pa.array(["a b c d", "c d e", "x", "", "c d"])))
    hashes, places = T.row_ngrams(T.words(block), 2)
    assert places.tolist() == [0, 1, 2, 4, 5, 8]
    assert hashes[2] == hashes[3] == hashes[5] and len(set(hashes.tolist())) == 4


def test_sorted_groups_across_batches():
    rng = random.Random(3)
    rows = sorted((rng.randrange(5), rng.randrange(3), i) for i in range(200))
    table = pa.table({"a": [r[0] for r in rows], "b": [r[1] for r in rows], "v": [r[2] for r in rows]})
    groups = list(sorted_groups(table.to_batches(max_chunksize=7), 2))
    assert sum(g.num_rows for g in groups) == 200
    assert len(groups) == len({r[:2] for r in rows})
    assert list(sorted_groups([], 1)) == []


def test_components_of_a_matrix():
    linked = np.zeros((6, 6), dtype=bool)
    for a, b in ((5, 1), (1, 3), (0, 4)):
        linked[a, b] = linked[b, a] = True
    assert components(linked).tolist() == [0, 1, 2, 1, 0, 1]
