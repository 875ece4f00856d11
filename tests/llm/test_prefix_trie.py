import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from gaugeflow.llm import prefix_trie as P


def brute(rows):
    """Nodes by a plain dictionary of prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        first = int(c / 100) * 100
        path = tuple(own.get(first, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * (len(path[-1][1]) if path else 0)
    return sorted((convs[0], len(path), members[path[:-1]][0] if path else -1, len(convs),
                   children[path], leaves[path], saved[path],
                   sha256(",".join(map(str, ends[path])).encode()).hexdigest())
                  for path, convs in members.items())


def nodes(spark, rows, **options):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = P.conversation_trie(table, **options).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs,
                   r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got)


def conversations(rng, count, texts=6, longest=9, copies=0.3):
    rows, made = [], []
    for c in rng.sample(range(-150, 900), count):
        turns = (list(rng.choice(made)) if made and rng.random() < copies else
                 [(rng.choice(["user", "bot", None]), rng.choice(["", None, *"abéλ文"[:texts]]))
                  for _ in range(rng.randint(1, longest))])
        made.append(turns)
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shards,band", [(1, 1, 64), (2, 5, 2), (3, 17, 3), (4, 40, 1)])
def test_equals_a_dictionary_of_prefixes(spark, monkeypatch, seed, shards, band):
    monkeypatch.setattr(P, "BAND", band)
    monkeypatch.setattr(P, "CHUNK", 3)
    rng = random.Random(seed)
    rows = conversations(rng, 120, texts=rng.choice([1, 3, 6]))
    assert nodes(spark, rows, shards=shards) == brute(rows)


def test_equal_conversations_over_many_shards(spark):
    rows = [(c, i, "user", f"turn {i}" * 3) for c in range(100, 400, 1) for i in range(8)]
    rows += [(c, i, "user", f"turn {i}" * 3) for c in range(400, 420) for i in range(70)]
    assert nodes(spark, rows, shards=13) == brute(rows)


def test_odd_tables(spark):
    assert nodes(spark, []) == []
    rows = [(None, 0, "a", "b"), (3, None, None, None), (3, 1, "user", ""), (5, 0, "u", "x" * 100_000)]
    assert nodes(spark, rows) == brute(rows)
    # equal turn numbers: by the digest of role and text, whatever the order of the rows
    tied = [(7, 1, "u", t) for t in "abcd"] * 2
    assert nodes(spark, tied) == nodes(spark, tied[::-1])
    table = spark.createDataFrame([(100, 0, "u", "x", 9, 9)],
                                  "conv_id long, turn long, role string, text string, digest int, depth int")
    assert P.conversation_trie(table).count() == 2
