import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gaugeflow.llm import automaton as A
from gaugeflow.llm import collocations as C


def brute(rows, min_count=10, top=2000, cover=50):
    f, n = [Counter() for _ in range(4)], Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[k].update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for k in (2, 3) for p, a in f[k].items() if a >= min_count}
    around = Counter()
    for p, a in candidates.items():
        if len(p) == 4:
            for part in (p[:3], (p[0], *p[2:])):
                around[part] = max(around[part], a)
    out = []
    for p, a in candidates.items():
        if 100 * around[p] >= cover * a:
            continue
        cuts = [(1_000_000 * a * a // (f[k][p[:k + 1]] * f[len(p) - 1 - k][(p[0], *p[k + 1:])]), k)
                for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), f[k][p[:k + 1]],
                    f[len(p) - 1 - k][(p[0], *p[k + 1:])]))
    ranked, ranks = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            ranked.append((lang, ranks[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return ranked


def mined(spark, rows, parts=3, **options):
    table = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return sorted(tuple(r) for r in C.collocations(table, **options).collect())


def corpus(rng, count, size=40):
    words = ["".join(rng.choice("abé文") for _ in range(rng.randint(1, 4))) for _ in range(size)]
    words += ["The", "the", "a\x00b", "O'K", "-", "x" * 50]
    marks = [" "] * 12 + [". ", ", ", "\n", "\t", "  ", " ; ", "!", "\x0b", "\xa0"]
    rows = []
    for _ in range(count):
        text = "".join(rng.choice(words[:rng.choice([5, len(words)])]) + rng.choice(marks)
                       for _ in range(rng.randint(0, 120)))
        rows.append((rng.choice(["en", "en", "de", None, ""]), rng.choice([text] * 9 + [None])))
    return rows


@pytest.mark.parametrize("seed,top,block,unite", [(1, 2000, 1 << 20, 1 << 20), (2, 7, 500, 300)])
def test_equals_plain_counters(spark, monkeypatch, seed, top, block, unite):
    monkeypatch.setattr(C, "SHARD_BYTES", block)
    monkeypatch.setattr(C, "UNITE", unite)
    monkeypatch.setattr(C, "LOOKUP", 20 if seed == 2 else 250_000)
    rows = corpus(random.Random(seed), 150)
    want = brute(rows, top=top)
    assert len(want) > 20 and mined(spark, rows, top=top) == want


def test_odd_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None), ("en", ""), ("en", " .\n")]) == []
    rows = [("en", "a b c " * 200_000), ("en", "a b c"), ("de", "a b"), (None, "a b c d " * 10)]
    assert mined(spark, rows) == brute(rows)
    table = spark.createDataFrame([("x", "p q " * 20, 1, "n")], "lang string, text string, rank int, score string")
    assert C.collocations(table).count() == 2


def random_automaton(rng, levels):
    words = ["", "a", "ab", "é", "文", "b", "\x00"]
    paths = [tuple(rng.choice(words).encode() for _ in range(levels)) for _ in range(rng.randint(1, 40))]
    labels, number = A.sorted_labels(pa.array([w for p in paths for w in p], pa.binary()))
    return Counter(paths), A.Automaton.build(labels, list(number.reshape(-1, levels).T))


def held(a):
    columns = [a.labels.take(pa.array(c)).to_pylist() for c in a.columns()]
    return {p: w for p, w in zip(zip(*columns), a.weights.tolist())}


@pytest.mark.parametrize("levels", [2, 3, 4])
def test_automata(levels):
    rng = random.Random(levels)
    for _ in range(100):
        (one, a), (two, b) = random_automaton(rng, levels), random_automaton(rng, levels)
        assert held(a) == one and list(held(a)) == sorted(one)
        assert held(A.union([a, b, a])) == one + two + one
        fields = [pa.field("n", pa.int32())]
        batch = A.as_batch([{"n": 1}, {"n": 2}], [a, b], fields)
        assert held(A.from_batch(batch, 1, levels)) == two and held(A.from_batch(batch, 0, levels)) == one
        place = a.find(b.labels, b.columns())
        assert {p: a.weights[i] if i >= 0 else 0 for p, i in zip(held(b), place)} == {p: one[p] for p in two}
        bound = rng.choice([*one, *two, (b"a", b"zz"), (b"aa",) * levels])
        bound = (*bound, *[b""] * (levels - len(bound)))
        assert a.place(bound) == sum(p < bound for p in one)
        chosen = np.flatnonzero([rng.random() < 0.5 for _ in one])
        if len(chosen):
            assert held(a.some(chosen)) == {sorted(one)[i]: one[sorted(one)[i]] for i in chosen}
            assert list(held(a.some(chosen))) == [sorted(one)[i] for i in chosen]
