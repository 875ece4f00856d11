import re
from collections import defaultdict
from hashlib import sha256

import pytest

from gaugeflow.llm import exact_dedup as D


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, left = min(known, default=None), 1
        for i in ids:
            stays = i == keep and left > 0
            left -= stays
            out.append((i, keep, len(ids), stays, sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def marked(spark, rows, **options):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in D.mark_duplicates(table, **options).collect()), key=repr)


ROWS = [(5, "a b"), (3, "a \t\n b"), (9, "a\xa0b"), (4, " a b"), (1, None), (2, ""), (None, ""),
        (7, "x" * 300 + "1"), (8, "x" * 300 + "2"), (10, "x" * 300 + "1"), (11, "\x1c"), (12, " "),
        (13, "\r\n\r\n"), (6, "é文"), (14, "é文"), (15, "y" * 200_000), (16, "y" * 200_000),
        (20, "twice"), (20, "twice"), (21, "alone"), (22, "a\x0bb"), (23, "a b" * 9), (23, "a c" * 9)]


@pytest.mark.parametrize("heavy", [4096, 4])
def test_equals_a_dictionary(spark, monkeypatch, heavy):
    monkeypatch.setattr(D, "HEAVY", heavy)
    assert marked(spark, ROWS) == brute(ROWS)


def test_empty_table_and_only_nulls(spark):
    assert marked(spark, []) == []
    assert marked(spark, [(None, None)] * 3) == sorted(
        [(None, None, 3, kept, sha256(b"").hexdigest()) for kept in (True, False, False)], key=repr)


def test_digests_of_survivors_only(spark):
    rows = [(1, "one"), (2, "three"), (3, "three"), (4, "seven"), (5, "eleven")]
    got = {r[0]: r[1:] for r in marked(spark, rows, digest_all=False)}
    assert got[1] == (1, 1, True, None) and got[5][3] is None
    assert got[3][:3] == (2, 2, False) and got[3][3] == sha256(b"three").hexdigest()


def test_rows_that_stay_keep_all_their_columns(spark):
    table = spark.createDataFrame(
        [(1, "a", "x", 5, True), (1, "a", "y", 6, False), (2, "a", "z", 7, False), (3, None, "w", 8, True)],
        "doc_id long, text string, keep_id string, _row int, kept boolean")
    got = D.without_duplicates(table)
    assert got.columns == table.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 3]
    assert D.without_duplicates(table.where("false")).count() == 0
