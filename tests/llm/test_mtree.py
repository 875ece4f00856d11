import math
import random

import numpy as np
import pyarrow as pa
import pytest

from gaugeflow.llm.mtree import Search, _pages, inner, top_k


def brute(rows, k=20, scale=64, every=20):
    good = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.setdefault((vec_id, tuple(math.floor(scale * x) for x in v)))
    out = []
    for q, a in good:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 3, "r") for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, rank int, score string").repartition(3)


def vectors(n, dims=8, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dims))
    return [(i, [float(np.float32(x)) for x in (centers[i % 5] + 0.2 * rng.normal(size=dims)) / 3])
            for i in range(n)]


@pytest.mark.parametrize("page_rows, query_block", [(512, 1000), (16, 7)])
def test_matches_brute_force(spark, page_rows, query_block):
    rows = vectors(400)
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2020, [1.0, None] + [0.0] * 6), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8),
             (None, [1.0] * 8), (2080, []), (2100, [0.5]), rows[20], rows[20]]
    got = top_k(frame(spark, rows), page_rows=page_rows, query_block=query_block).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_few_rows_and_none(spark):
    rows = vectors(7)
    got = top_k(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows) and len(got) == 6
    assert top_k(frame(spark, rows).limit(0)).count() == 0
    assert top_k(frame(spark, [(1, [0.1])])).count() == 0


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** 24 for _ in range(4)]) for i in range(50)]
    got = top_k(frame(spark, rows, "double")).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
    a = np.array([[2 ** 31, 1]])
    assert inner(a, np.array([[2 ** 31, 3]])).tolist() == [[2 ** 62 + 3]]
    assert inner(a, np.array([[2 ** 62, 0]])).tolist() == [[2 ** 63 - 1]]


def test_bounds_rule_out_far_pages():
    rng = np.random.default_rng(4)
    cells = np.array([[100, 0], [-100, 0]])
    rows = [np.rint(c + rng.normal(size=(300, 2)) * 5).astype(np.int64) for c in cells]
    pages = []
    for cell, v in enumerate(rows):
        for row in _pages(cell, cells[cell], np.arange(300) + 1000 * cell, v, 64).to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            x = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1)
            center = np.frombuffer(row["center"], np.int64)
            d = np.frombuffer(row["distances"], np.float64)
            assert (np.sqrt(((x - center) ** 2).sum(1)) <= d + 1e-9).all() and row["page_radius"] == d.max()
            pages.append((row["cell"], row["page_radius"], row["to_cell"], center, ids, x, d))
    queries = np.array([[90, 10]])
    floor = np.partition(inner(queries, rows[0]), -5, axis=1)[:, -5]
    task = Search(np.array([-1]), queries, floor, cells, 5)
    task.visit(pages)
    best = task.best()
    scores = np.sort(inner(queries, np.concatenate(rows))[0])[::-1][:5]
    assert best[:, 2].tolist() == scores.tolist()
    assert task.held < 60
