import hashlib
import random

from gaugeflow.llm.decontamination import contamination, without_contaminated
from test_text_kernels import plain_words


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for n in {len(p) for p in windows}:
            for i in range(len(w) - n + 1):
                if (who := windows.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= who - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame(
        [(d, t, 1, "x", 2) for d, t in docs],
        "doc_id long, text string, row long, windows string, n_words int").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"))


def test_matches_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["the", "a", "of", "Ünder", "in", "x9", "and", "to"]
    phrase = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, phrase(rng.choice([3, 9, 10, 12, 30]))) for i in range(20)]
    items += [(30, None), (31, ""), (32, "!!"), (None, phrase(11)), items[0], (33, "same " * 40), (7, "Solo")]
    docs = [(i, phrase(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, f"{phrase(5)}; {items[i][1].upper()}\n{phrase(4)}") for i in range(20)]
    docs += [(200, None), (201, ""), (202, "same " * 30), (202, "same " * 30), (None, items[2][1]),
             (203, " ".join([items[3][1]] * 700)), (204, "solo"), (205, "so lo")]
    documents, benchmark = frames(spark, docs, items)
    got = sorted((tuple(r) for r in contamination(documents, benchmark).collect()), key=str)
    assert got == brute(docs, items)
    clean = without_contaminated(documents, benchmark)
    assert clean.columns == documents.columns
    want = sorted(((d, t) for (d, t), r in zip(docs, [brute([x], items)[0] for x in docs]) if not r[5]), key=str)
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == want


def test_empty_tables(spark):
    documents, benchmark = frames(spark, [(1, "a b c")], [])
    row = contamination(documents, benchmark).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)
    assert contamination(documents.limit(0), benchmark).count() == 0
    assert without_contaminated(documents, benchmark).count() == 1
