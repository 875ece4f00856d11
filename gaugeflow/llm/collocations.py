"""Phrase collocations per language, counted with weighted acyclic automata.

Every block of texts is a shard: its phrases, sorted, become an automaton whose last arcs
carry counts (see ``automaton``). Automata are cut at the same paths everywhere, so that a
range of paths meets in one task, which unites its parts by adding weights; one common word
or pair is a few arcs per shard and its followers are spread over many ranges. Phrases grow
a word at a time: a phrase can be as frequent as ``min_count`` only if its parts are, so the
shards of two words keep pairs of frequent words, those of three words keep frequent pairs
(filters of bounded size, which may let others pass; these fail the count). The parts of
candidates are looked up by composition: a task collects the distinct parts of its
candidates as an automaton, sends its ranges to the ranges of counts, gets them back with
weights, and scores. A common part is asked for once per task, not once per phrase.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count again;
an empty table gives an empty result; other columns are ignored. A document longer than a
block is a block of its own.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import automaton as A
from gaugeflow.llm import text as T
from gaugeflow.llm.automaton import Automaton
from gaugeflow.llm.keyfilter import KeyFilter, build_filter
from gaugeflow.session import materialize

LONGEST = 3
#: Bytes of text in a shard.
SHARD_BYTES = 6 << 20
#: The ranges are cut at quantiles of the phrases of about so many documents, of which a task
#: gives so many phrases, with words up to so many bytes. Results do not depend on the cuts.
SAMPLE_DOCS, SAMPLE_PATHS, CUT_BYTES = 4000, 4096, 64
#: Ranges per shuffle partition: a task unites one range at a time, and holds its parts.
RANGES = 3
#: Paths that are gathered before they are united.
UNITE = 2_000_000
#: Frequent phrases that one task looks up and scores.
LOOKUP = 250_000
SALTS = 16

ENDS_PIECE = b".,;:!?\x0a\x0b\x0c\x0d"
ENDS_WORD = b" \t"

COUNTS = f"range int, {A.FIELDS}, keys array<long>, langs array<binary>, totals array<long>"
ASK = f"order int, target int, asking int, origin int, {A.FIELDS}"
ANSWER = f"asking int, origin int, part int, {A.FIELDS}"
SCORED = "lang string, phrase string, a long, l long, r long, score long"
#: Parts of an answer: weights of one or two words (1, 2), or the candidates themselves.
CANDIDATES = 0


def _positions(block: T.Block, langs: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Labels, and for each word its language, its own number, and its piece."""
    data = T.lower_table()[block.data]
    ends = np.zeros(256, bool)
    ends[list(ENDS_PIECE)] = True
    apart = ends.copy()
    apart[list(ENDS_WORD)] = True
    kind = np.int32 if len(data) < 1 << 31 else np.int64
    inside, breaks = ~apart[data], np.cumsum(ends[data], dtype=kind)
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = block.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= inside[edges]
    stops[edges - 1] |= inside[edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    labels, number = A.sorted_labels(pa.concat_arrays([words, langs.cast(pa.binary())]))
    row = np.searchsorted(block.offsets, starts, side="right") - 1
    # a row begins a piece as well
    return labels, number[len(starts):][row], number[:len(starts)], breaks[starts] + row


def _hashes(labels: pa.Array) -> np.ndarray:
    data, offsets = T.utf8(labels)
    begin = offsets[0]
    return T.span_hashes(data[begin:offsets[-1]], offsets[:-1] - begin, offsets[1:] - begin)


def _keys(hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for column, factor in zip(columns, T.constants(LONGEST + 1, 13)):
        total += hashes[column] * factor
    return T.mix(total).view(np.int64)


def _shards(batches, order: int, frequent: KeyFilter | None):
    """The automaton of the phrases of ``order`` words of each block of (lang, text)."""
    for batch in batches:
        for block in T.blocks(batch.column("text"), SHARD_BYTES):
            langs = batch.column("lang").slice(block.first, block.rows)
            labels, lang, word, piece = _positions(block, langs)
            if len(word) < order:
                continue
            count = len(word) - order + 1
            columns = [lang[:count], *(word[i:i + count] for i in range(order))]
            good = piece[:count] == piece[order - 1:]
            if frequent is not None:  # of the first and the last part, a word shorter
                hashes = _hashes(labels)
                part = [lang, *(word[i:len(word) - order + 2 + i] for i in range(order - 1))]
                passes = frequent.passes(_keys(hashes, [c[:count + 1] for c in part]))
                good &= passes[:-1] & passes[1:]
            if good.any():
                yield Automaton.build(labels, [c[good] for c in columns])


def _bounds(sample: DataFrame, order: int, frequent: KeyFilter | None, ranges: int) -> list[tuple]:
    """Paths at which the ranges are cut."""
    def paths(batches):
        for shard in _shards(batches, order, frequent):
            at = np.unique(np.linspace(0, len(shard) - 1, min(len(shard), SAMPLE_PATHS)).astype(int))
            yield pa.record_batch({"path": pa.array(
                [[w[:CUT_BYTES] for w in shard.path(i)] for i in at.tolist()], pa.list_(pa.binary()))})

    rows = sample.mapInArrow(paths, "path array<binary>").limit(ranges * 1000).collect()
    found = sorted(tuple(map(bytes, r.path)) for r in rows)
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def _cut(whole: Automaton, bounds: list[tuple]):
    """(range, part) of an automaton."""
    places = [0, *(whole.place(b) for b in bounds), len(whole)]
    for number, (low, high) in enumerate(zip(places, places[1:])):
        if high > low:
            yield number, whole.some(np.arange(low, high))


def _counts(docs: DataFrame, order: int, frequent: KeyFilter | None, bounds: list[tuple],
            min_count: int) -> DataFrame:
    """Per range the automaton of phrases with at least ``min_count`` occurrences, their keys,
    and how many phrases each language has in all."""
    head = [pa.field("range", pa.int32())]

    def cut(batches):
        for shard in _shards(batches, order, frequent):
            parts = list(_cut(shard, bounds))
            yield A.as_batch([{"range": n} for n, _ in parts], [p for _, p in parts], head)

    def unite(batches):
        here, parts, size = None, [], 0
        for batch in batches:
            for row, number in enumerate(batch.column("range").to_pylist()):
                if number != here and parts:
                    yield settled(here, A.union(parts))
                    parts, size = [], 0
                here = number
                parts.append(A.from_batch(batch, row, order + 1))
                size += len(parts[-1])
                if size > UNITE and len(parts) > 1:
                    parts = [A.union(parts)]
                    size = len(parts[0]) // 2
        if parts:
            yield settled(here, A.union(parts))

    def settled(number: int, whole: Automaton) -> pa.RecordBatch:
        columns = whole.columns()
        totals = np.zeros(len(whole.words[0]), np.int64)
        np.add.at(totals, np.searchsorted(whole.words[0], columns[0]), whole.weights)
        langs = whole.labels.take(pa.array(whole.words[0]))
        kept = whole.some(np.flatnonzero(whole.weights >= min_count))
        keys = _keys(_hashes(kept.labels), kept.columns()) if len(kept) else np.zeros(0, np.int64)
        batch = A.as_batch([{"range": number}] * bool(len(kept)), [kept] * bool(len(kept)), head)
        if not len(kept):
            batch = pa.RecordBatch.from_pylist([{"range": number}], batch.schema)
        for name, value, kind in (("keys", keys, pa.int64()), ("langs", langs, pa.binary()),
                                  ("totals", totals, pa.int64())):
            batch = batch.append_column(name, pa.array([value], pa.list_(kind)) if name != "langs" else
                                        pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value))
        return batch

    return materialize(
        docs.mapInArrow(cut, f"range int, {A.FIELDS}")
        .repartition(len(bounds) + 1, "range").sortWithinPartitions("range")
        .mapInArrow(unite, COUNTS), f"phrases-{order}")


def _asked(order: int, whole: Automaton) -> dict[int, Automaton]:
    """The parts, by their number of words, that the scores of candidates need. Pairs carry
    the count of the most frequent candidate around them."""
    lang, *words = whole.columns()
    ends = [words[0], words[-1]]
    asked = {1: Automaton.build(whole.labels, [np.tile(lang, 2), np.concatenate(ends)])}
    if order == 3:
        asked[2] = Automaton.build(whole.labels, [
            np.tile(lang, 2), np.concatenate(words[:2]), np.concatenate(words[1:])],
            np.tile(whole.weights, 2), np.maximum)
    return asked


def _divided(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[int]:
    return [1_000_000 * x * x // (l * r) for x, l, r in zip(a.tolist(), left.tolist(), right.tolist())]


def _scores(order: int, whole: Automaton, one: Automaton, two: Automaton | None):
    """Counts of the parts and the score, at the cut that scores lowest."""
    lang, *words = whole.columns()

    def count(source: Automaton, *columns) -> np.ndarray:
        return source.weights[source.find(whole.labels, [lang, *columns])]

    if order == 2:
        left, right = count(one, words[0]), count(one, words[1])
        return left, right, _divided(whole.weights, left, right)
    cuts = [(count(one, words[0]), count(two, *words[1:])), (count(two, *words[:2]), count(one, words[2]))]
    first, second = (np.array(_divided(whole.weights, *cut), np.int64) for cut in cuts)
    early = first <= second
    return (np.where(early, cuts[0][0], cuts[1][0]), np.where(early, cuts[0][1], cuts[1][1]),
            np.where(early, first, second).tolist())


def _read(table, order_of) -> list[tuple[int, Automaton]]:
    return [(row, A.from_batch(table, row, order_of(row) + 1)) for row in range(table.num_rows)]


def _composed(counts: dict[int, DataFrame], bounds: dict[int, list[tuple]], cover: int) -> DataFrame:
    """Look the parts of all candidates up and score the candidates that stay."""
    spark = counts[1].sparkSession
    total = sum(c.agg(F.sum(F.size("keys"))).first()[0] or 0 for c in counts.values())
    # fewer, larger groups of ranges than the counts were dealt to
    groups = max(total // LOOKUP, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4, 1)
    group = {o: [r * groups // (len(b) + 1) for r in range(len(b) + 1)] for o, b in bounds.items()}
    cuts = {o: [(b[r], group[o][r + 1]) for r in range(len(b)) if group[o][r] != group[o][r + 1]]
            for o, b in bounds.items()}

    held = None
    for order, rows in counts.items():
        dealt = rows.where(F.size("words") > 0).select(
            F.lit(order).alias("order"),
            F.expr(f"cast(range * {groups} div {len(bounds[order]) + 1} AS int)").alias("target"),
            *[f.name for f in A.field_types()])
        held = dealt if held is None else held.unionByName(dealt)
    asking = [pa.field(n, pa.int32()) for n in ("order", "target", "asking", "origin")]

    def ask(batches):
        for batch in batches:
            orders, origins = (batch.column(n).to_pylist() for n in ("order", "target"))
            for row, whole in _read(batch, lambda r: orders[r]):
                if orders[row] == 1:
                    continue
                for part, parts in _asked(orders[row], whole).items():
                    targets = [0, *(g for _, g in cuts[part])]
                    cut = list(_cut(parts, [b for b, _ in cuts[part]]))
                    yield A.as_batch(
                        [{"order": part, "target": targets[n], "asking": orders[row], "origin": origins[row]}
                         for n, _ in cut], [p for _, p in cut], asking)

    answering = [pa.field(n, pa.int32()) for n in ("asking", "origin", "part")]

    def answer(known: pa.Table, asked: pa.Table) -> pa.Table:
        rows, automata = [], []
        if known.num_rows:
            order, target = known.column("order")[0].as_py(), known.column("target")[0].as_py()
            whole = A.union([p for _, p in _read(known, lambda r: order)])
            around = np.zeros(len(whole), np.int64)
            for row, parts in _read(asked, lambda r: order):
                place = whole.find(parts.labels, parts.columns())
                np.maximum.at(around, place, parts.weights)
                rows.append({"asking": asked.column("asking")[row].as_py(),
                             "origin": asked.column("origin")[row].as_py(), "part": order})
                automata.append(replace(parts, weights=whole.weights[place]))
            if order > 1:
                stay = whole.weights * cover > around * 100 if order == 2 else np.ones(len(whole), bool)
                if stay.any():
                    rows.append({"asking": order, "origin": target, "part": CANDIDATES})
                    automata.append(whole.some(np.flatnonzero(stay)))
        return pa.Table.from_batches([A.as_batch(rows, automata, answering)])

    def score(table: pa.Table) -> pa.Table:
        order = table.column("asking")[0].as_py()
        parts: dict[int, list[Automaton]] = {}
        numbers = table.column("part").to_pylist()
        for row, read in _read(table, lambda r: numbers[r] or order):
            parts.setdefault(numbers[row], []).append(read)
        out = {name: [] for name in ("lang", "phrase", "a", "l", "r", "score")}
        if CANDIDATES in parts:
            whole = A.union(parts[CANDIDATES])
            # several ranges may have asked for the same part
            looked_up = [A.union(parts[n], np.maximum) if n in parts else None for n in (1, 2)]
            left, right, scores = _scores(order, whole, *looked_up)
            words = [whole.labels.take(pa.array(c)).to_pylist() for c in whole.columns()]
            out = {"lang": [w.decode() for w in words[0]],
                   "phrase": [b" ".join(p).decode() for p in zip(*words[1:])],
                   "a": whole.weights, "l": left, "r": right, "score": scores}
        return pa.table({n: pa.array(v, pa.string() if n in ("lang", "phrase") else pa.int64())
                         for n, v in out.items()})

    held = materialize(held, "phrases")
    questions = held.mapInArrow(ask, ASK)
    answers = held.groupBy("order", "target").cogroup(
        questions.groupBy("order", "target")).applyInArrow(answer, ANSWER)
    return answers.groupBy("asking", "origin").applyInArrow(score, SCORED)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 10,
                 top: int = 2000, cover: int = 50) -> DataFrame:
    """The ``top`` phrases of two and three words per language: lang, rank, phrase, a, l, r, n
    and score.

    Phrases have at least ``min_count`` occurrences; one that lies in a longer candidate with
    at least ``cover`` percent of its occurrences is left out.
    """
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    sample = materialize(docs.sample(share, seed=7).coalesce(4), "phrases-sample")
    counts, bounds, frequent = {}, {}, None
    for order in range(1, LONGEST + 1):
        bounds[order] = _bounds(sample, order, frequent, ranges)
        counts[order] = _counts(docs, order, frequent, bounds[order], min_count)
        if order < LONGEST:
            frequent = build_filter(counts[order].select(F.explode("keys").alias("key")), "key")
    totals = counts[1].select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(
        F.col("t.langs").cast("string").alias("lang")).agg(F.sum("t.totals").alias("n"))
    scored = materialize(_composed(counts, bounds, cover), "phrases-scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.hash("phrase"), F.lit(SALTS))
    best = scored.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
