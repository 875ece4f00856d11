import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeflow.llm import bpe
from gaugeflow.llm import text as T
from gaugeflow.llm.token_attribution import RULES, allocate, field_tokens, line_tokens

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL, CLASSES = bpe.encoder(PATH), bpe.char_classes()
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                              mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
ODD = list("abc'sstrevdml' ''\n\t  \r12³²é你好👍🏽  !?.,--==_ABZ\x1c\x85ﬁǅ ")


def encode(texts, limit=T.BLOCK_BYTES):
    numbers = [str(i).encode() for i in range(len(MODEL.tokens))]
    out = []
    for block in T.blocks(pa.array(texts, pa.string()), limit):
        done = bpe.Encoded(MODEL, CLASSES, block)
        rows = [[int(i) for i in r.split()] for r in done.joined(numbers, b" ")]
        assert done.row_counts().tolist() == [len(r) for r in rows]
        out += list(zip(rows, done.joined(MODEL.tokens, b"")))
    return out


def check(texts, limit=T.BLOCK_BYTES):
    for text, (ids, raw) in zip(texts, encode(texts, limit), strict=True):
        assert ids == REFERENCE.encode_ordinary(text or "")
        assert raw == (text or "").encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=50), st.text(st.sampled_from(ODD), max_size=60)),
                min_size=1, max_size=6), st.integers(1, 200))
def test_equals_the_library(texts, limit):
    check(texts, limit)


def test_long_and_repetitive_texts():
    check(["a" * n for n in range(130)] + ["=" * 500, "ab" * 400, "x" * 5000, "'" * 99, "日本語" * 200,
           " " * 300 + "a", "\n" * 77, "word " * 30_000, None, ""])


def thue_morse(size):
    word = "ab"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [512, 1024, 2048, 8192])
def test_different_pieces_of_equal_polynomial_hash(size):
    one, other = thue_morse(size)
    check([one, other, f"{one} {other}", one])


def test_pieces_are_told_apart_by_their_bytes():
    # all hashes equal: groups follow the bytes
    data = np.frombuffer(b"abcabdabcab", np.uint8)
    starts, ends = np.array([0, 3, 6, 9]), np.array([3, 6, 9, 11])
    first, group = bpe.told_apart(data, starts, ends, np.array([0]), np.zeros(4, int))
    assert group.tolist()[0] == group.tolist()[2] and len(set(group.tolist())) == 3
    assert [bytes(data[starts[f]:ends[f]]) for f in first[group]] == [b"abc", b"abd", b"abc", b"ab"]


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "汉字语言处理系统" * 12_000,
                                  "".join(random.Random(3).choice("的一是不了人我在有他这中大来上") for _ in range(90_000)),
                                  "".join(random.Random(5).choice("abcdefgh") for _ in range(200_000))])
def test_very_long_pieces(text):
    begin = time.process_time()
    got = encode([text])[0]
    rate = (time.process_time() - begin) / len(text.encode())
    assert got[0] == REFERENCE.encode_ordinary(text) and got[1] == text.encode()
    assert rate < 20e-6  # seconds a byte; byte by byte it was 100


def test_appends_and_edits_equal_a_fresh_encoding():
    rng = random.Random(4)
    words = ["the", " of", "'s", "  ", "\n", "don't", "é", "123", "!!", " in", "ation", "x"]
    for _ in range(25):
        text = bpe.EditableText(MODEL, "".join(rng.choice(words) for _ in range(rng.randrange(12))))
        plain = text.text
        for _ in range(6):
            new = "".join(rng.choice(words) for _ in range(rng.randrange(4)))
            if rng.random() < 0.4:
                text.append(new)
                plain += new
            else:
                a, b = sorted(rng.randrange(len(plain) + 1) for _ in range(2))
                text.replace(a, b, new)
                plain = plain[:a] + new + plain[b:]
            assert text.text == plain
            assert text.ids() == REFERENCE.encode_ordinary(plain)


def test_each_prefix_has_one_last_token():
    piece = b"understandably"
    last = MODEL.last_tokens(piece)
    for end in range(1, len(piece) + 1):
        assert last[end] == REFERENCE._encode_single_piece(piece[:end])[-1]


def documents(spark):
    rows = [(1, "Hello world\nsecond  line"), (2, None), (3, ""), (3, ""), (None, "\n\n x"), (5, "one\n\n\ntwo'll\n")]
    return spark.createDataFrame([(d, t, "t", 0.5) for d, t in rows],
                                 "doc_id long, text string, section string, n_tokens double").repartition(2)


def test_documents(spark):
    rows = documents(spark)
    texts = sorted(((r.doc_id, r.text) for r in rows.collect()), key=str)
    want = []
    for doc, text in texts:
        ids = REFERENCE.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe.encoded_documents(rows, PATH).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.encoded_documents(rows.limit(0), PATH).count() == 0


def spans(text):
    at, out = 0, []
    for i in REFERENCE.encode_ordinary(text):
        out.append((at, at + len(MODEL.tokens[i])))
        at = out[-1][1]
    return out


def given_to(rule, span, bounds):
    inside = [max(0, min(span[1], b) - max(span[0], a)) for a, b in zip(bounds, bounds[1:])]
    first = next(i for i, x in enumerate(inside) if x)
    last = max(i for i, x in enumerate(inside) if x)
    if rule == "split":
        return [x / sum(inside) for x in inside]
    owner = {"start": first, "end": last, "majority": inside.index(max(inside))}[rule]
    return [float(i == owner) for i in range(len(inside))]


@pytest.mark.parametrize("rule", RULES)
def test_lines_get_their_tokens(spark, rule):
    rows = documents(spark)
    got = sorted((tuple(r) for r in line_tokens(rows, PATH, rule).collect()), key=str)
    want = []
    for r in rows.collect():
        raw = (r.text or "").encode()
        lines = raw.splitlines(keepends=True) or [b""]
        bounds = [0]
        for line in lines:
            bounds.append(bounds[-1] + len(line))
        shares = [given_to(rule, s, bounds) for s in spans(r.text or "")] or [[0.0] * len(lines)]
        for i, line in enumerate(lines):
            crossing = sum(1 for a, b in spans(r.text or "") if bounds[i] <= a < bounds[i + 1] < b)
            want.append((r.doc_id, i, len(raw[:bounds[i]].decode()), len(line.decode()),
                         sum(s[i] for s in shares), crossing))
    assert got == sorted(want, key=str)
    assert sum(r[4] for r in got) == pytest.approx(sum(
        len(REFERENCE.encode_ordinary(r.text or "")) for r in rows.collect()))


def test_fields_get_their_tokens(spark):
    rows = spark.createDataFrame([(1, "Title's", "a body\n", 2), (2, None, "", 3), (3, "", "x", 4)],
                                 "doc_id long, title string, body string, n_tokens_title int")
    got = {r.doc_id: r for r in field_tokens(rows, ["title", "body"], PATH, "start").collect()}
    assert got[1].n_tokens_title + got[1].n_tokens_body == len(REFERENCE.encode_ordinary("Title's\na body\n"))
    assert got[2].n_tokens_title == 1 and got[2].n_tokens_body == 0
    with pytest.raises(ValueError):
        allocate(None, None, None, "other")
