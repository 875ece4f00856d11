"""Exact substring deduplication with a logarithmic family of suffix arrays.

Every byte is removed that lies in a string of LENGTH bytes which also starts
earlier (smaller doc_id, or the same document at an earlier place). Strings are
judged on the input, overlaps count, and matches stay within documents.

Suffixes. Of the KEY-byte strings that start within each string of LENGTH bytes,
the one with the smallest hash marks a suffix (the leftmost of equals). Equal
strings mark equal suffixes, so only marked ones, one in about 38, are indexed. A
suffix array orders them by the hash of their first KEY bytes; this is not the
alphabet's order, but all a scan for matches needs: equal beginnings are
neighbours. Full arrays of every byte's suffix would be several times the input.
The strings that a suffix marks form a run; an entry holds the run's hash.

Family. New batches get suffix arrays, split into buckets of the order. A new array
is merge-scanned against every existing level, and levels of equal rank merge into
one of the next, so n batches leave log n levels and an entry is rewritten log n
times. Levels are bucketed tables: scans and merges move no data between tasks.
Equal runs are settled by the scan. Where only the beginnings agree, the scan asks
for the bytes of the runs on both sides; these, which lie at the ends of matches,
are compared string by string. Beginnings asked for HOT times or more are compared
by strings dealt out by their own hash, so no task gathers a crowd. Each task keeps
only the first of equal runs, so copies cost a row per task.

Null and empty texts and texts shorter than LENGTH lose nothing. A null doc_id
counts as the largest. Rows that share a doc_id are judged as one document laid
over itself: equal strings at equal places do not remove each other. Other columns
are ignored. Hashes are compared in pairs of 64 bits.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import text as T
from gaugeflow.llm.groups import sorted_groups
from gaugeflow.session import materialize, shared_dir
from gaugeflow.sources.files import delete_folder

LENGTH, KEY = 100, 24
#: Runs asked for from which a beginning's strings are dealt out one by one.
HOT = 4096
#: Batches of a whole table, bytes of text per bucket, suffixes held by a task.
BATCHES, BUCKET_BYTES, HELD = 3, 16 << 20, 600_000
#: Bytes of text looked at once, strings compared at once.
LOOK_BYTES, COMPARED = 256 << 10, 400_000
LARGEST = np.iinfo(np.int64).max


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD6E8FEB86659FD93
    steps = np.full(n + 1, np.uint64(base))
    steps[0] = 1
    forward = np.cumprod(steps)
    steps[1:] = np.uint64(pow(base, -1, 1 << 64))
    return forward, np.cumprod(steps)


class Runs:
    """Columns of runs: the marked suffix's key, the run's hash, first string, strings, row."""

    def __init__(self, key, whole, start, strings, row) -> None:
        self.key, self.whole, self.start, self.strings, self.row = key, whole, start, strings, row


class Marker:
    """Finds the runs of a block; keeps tables of powers between blocks."""

    def __init__(self, length: int = LENGTH, key: int = KEY) -> None:
        self.length, self.key = length, min(key, length)
        self.tables = _powers(LOOK_BYTES + 1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.tables[0]) < len(data) + 1:
            self.tables = _powers(2 * len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.tables[0][:len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return T.mix((sums[ends] - sums[starts]) * self.tables[1][starts])

    def runs(self, block: T.Block) -> Runs:
        data, n, k, length = block.data, len(block.data), self.key, self.length
        if n < length:
            empty = np.zeros(0, np.int64)
            return Runs(empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty)
        sums = self.sums(data)
        keys = T.mix((sums[k:] - sums[:-k]) * self.tables[1][:n - k + 1])
        least = (keys & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(keys), dtype=np.uint64)
        width, want = 1, length - k + 1
        while 2 * width <= want:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < want:
            least = np.minimum(least[:len(least) - (want - width)], least[want - width:])
        marked = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        sizes = np.diff(block.offsets)
        within = np.zeros(n + 1, np.int32)
        full = sizes >= length
        np.add.at(within, block.offsets[:-1][full], 1)
        np.add.at(within, block.offsets[1:][full] - length + 1, -1)
        valid = np.cumsum(within)[:len(marked)] > 0
        same = np.zeros(len(marked) + 1, dtype=bool)
        same[1:-1] = valid[1:] & valid[:-1] & (marked[1:] == marked[:-1])
        start = np.flatnonzero(valid & ~same[:-1])
        last = np.flatnonzero(valid & ~same[1:])
        place = marked[start]
        whole = self.hashes(sums, start, last + length)
        shape = ((place - start) << 20 | (last - start)).astype(np.uint64)
        return Runs(keys[place], T.mix(whole ^ T.mix(shape)), start, last - start + 1,
                    np.searchsorted(block.offsets, start, side="right") - 1)


def _ordered(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LARGEST))).alias("doc"),
        F.xxhash64(text).alias("text_key"), text.alias("text"))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _split(bucket: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row per bucket with its part of each column as bytes, in the given order."""
    order = np.argsort(bucket, kind="stable")
    values, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first[1:], len(order))
    parts = [c[order] for c in columns]
    return pa.record_batch(
        [pa.array(values)] + [pa.array([p[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())
                              for p in parts], names=["bucket", *names])


def _column(table, name: str, kind) -> np.ndarray:
    column = table.column(name)
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind)


#: What travels of runs, strings and spans (whose end stands in the place of the strings).
RUN = {"key": np.uint64, "whole": np.uint64, "doc": np.int64, "text_key": np.int64,
       "start": np.int32, "strings": np.uint16}
STRING = {"key": np.uint64, "whole": np.uint64, "doc": np.int64, "text_key": np.int64,
          "start": np.int32}
SPAN = {"doc": np.int64, "text_key": np.int64, "start": np.int32, "strings": np.int32}
#: Kinds of rows: settled spans, runs of an array or with their bytes, strings, runs asked for.
SPANS, RUNS, STRINGS, ASKED = range(4)
COLUMNS = ("key", "whole", "doc", "text_key", "start", "strings", "bytes")
DEALT = "kind int, bucket long, " + ", ".join(f"{c} binary" for c in COLUMNS)


def _read(table, kinds: dict) -> dict[str, np.ndarray]:
    """The joined columns of rows of one kind."""
    return {c: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
            for c, kind in kinds.items()}


def _picked(cols: dict, where: np.ndarray) -> dict[str, np.ndarray]:
    return {c: v[where] for c, v in cols.items()}


def _joined(parts: list[dict]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _again(cols: dict) -> tuple[np.ndarray, np.ndarray]:
    """Which rows repeat an earlier equal (key, whole); and the others, in order, each once."""
    order = np.argsort(cols["key"])
    out, keep = np.zeros(len(order), dtype=bool), np.ones(len(order), dtype=bool)
    place = _mixed(cols["key"][order])
    if not len(place):
        return out, order
    # most beginnings stand alone; only the others need a finer order
    some = order[place]
    some = some[np.lexsort([cols[c][some] for c in ("text_key", "start", "doc", "whole", "key")])]
    order[place] = some
    k, w, d, s, t = (cols[c][some] for c in ("key", "whole", "doc", "start", "text_key"))
    head = np.append(True, (k[1:] != k[:-1]) | (w[1:] != w[:-1]))
    at = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = (d != d[at]) | (s != s[at])
    same = np.append(False, t[1:] == t[:-1]) & ~head & ~later
    out[some] = later
    keep[place] = ~later & ~same
    return out, order[keep]


def _held(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values stand in an ordered array."""
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _run_spans(cols: dict, length: int) -> list[np.ndarray]:
    """The bytes of whole runs as spans."""
    start = cols["start"].astype(np.int64)
    return [cols["doc"], cols["text_key"], start, start + cols["strings"] - 1 + length]


def _mixed(keys: np.ndarray) -> np.ndarray:
    """Places of a sorted array whose value stands there more than once."""
    same = keys[1:] == keys[:-1]
    return np.flatnonzero(np.append(False, same) | np.append(same, False))


def _merge_spans(doc, text_key, start, end) -> list[np.ndarray]:
    """Join spans of a document that overlap or touch."""
    order = np.lexsort((start, text_key, doc))
    doc, text_key, start, end = doc[order], text_key[order], start[order], end[order]
    if not len(doc):
        return [doc, text_key, start, end]
    other = np.append(True, (doc[1:] != doc[:-1]) | (text_key[1:] != text_key[:-1]))
    group = np.cumsum(other) - 1
    # raise each document's places above all earlier ones, so one running maximum serves all
    lift = group.astype(np.int64) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    head = np.append(True, (start + lift)[1:] > reach[:-1])
    at = np.flatnonzero(head)
    return [doc[at], text_key[at], start[at],
            (reach[np.append(at[1:], len(doc)) - 1] - lift[at])]


def _string_hashes(marker: Marker, data: np.ndarray, first: np.ndarray, strings: np.ndarray):
    """Hash of every string of runs whose bytes begin at `first`, with its run and number."""
    run = np.repeat(np.arange(len(first)), strings)
    number = np.arange(len(run)) - np.repeat(np.cumsum(strings) - strings, strings)
    at = first[run] + number
    return marker.hashes(marker.sums(data), at, at + marker.length), run, number


def _string_spans(cols: dict, length: int) -> list[np.ndarray]:
    start = cols["start"].astype(np.int64)
    return [cols["doc"], cols["text_key"], start, start + length]


def _strings(marker: Marker, cols: dict, data: np.ndarray, first: np.ndarray) -> dict:
    """All strings of runs whose bytes begin at `first`, as columns."""
    hashes, run, number = _string_hashes(marker, data, first, cols["strings"].astype(np.int64))
    return {"key": cols["key"][run], "whole": hashes, "doc": cols["doc"][run],
            "text_key": cols["text_key"][run],
            "start": (cols["start"][run] + number).astype(np.int32)}


def _compare(marker: Marker, cols: dict, data: np.ndarray) -> list[np.ndarray]:
    """Spans of all strings of runs that occur earlier among these runs."""
    length = marker.length
    first = np.concatenate([[0], np.cumsum(cols["strings"].astype(np.int64) + length - 1)])[:-1]
    order = np.argsort(cols["key"], kind="stable")
    keys, total = cols["key"][order], np.cumsum(cols["strings"][order].astype(np.int64))
    spans, at = [], 0
    while at < len(order):
        to = int(np.searchsorted(total, (total[at - 1] if at else 0) + COMPARED, side="right"))
        to = int(np.searchsorted(keys, keys[min(max(to - 1, at), len(keys) - 1)], side="right"))
        part = order[at:to]
        sizes = cols["strings"][part].astype(np.int64) + length - 1
        offset = np.concatenate([[0], np.cumsum(sizes)])
        index = np.repeat(first[part] - offset[:-1], sizes) + np.arange(int(offset[-1]))
        found = _strings(marker, _picked(cols, part), data[index], offset[:-1])
        again, _ = _again(found)
        spans.append(_string_spans(_picked(found, again), length))
        at = to
    return _merge_spans(*[np.concatenate([s[i] for s in spans]) for i in range(4)])


def _dealt(kind: int, bucket: np.ndarray, cols: dict, kinds: dict,
           data: list[bytes] | None = None) -> pa.RecordBatch:
    """Rows of one kind, one per bucket, which keep the order of their entries."""
    where = np.argsort(bucket, kind="stable")
    values, first = np.unique(bucket[where], return_index=True)
    ends = np.append(first[1:], len(where))
    arrays = [pa.array(np.full(len(values), kind, np.int32)), pa.array(values)]
    for name in COLUMNS:
        if name in kinds:
            part = cols[name][where].astype(kinds[name], copy=False)
            arrays.append(pa.array([part[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()))
        elif name == "bytes" and data is not None:
            arrays.append(pa.array([b"".join([data[i] for i in where[a:b].tolist()])
                                    for a, b in zip(first, ends)], pa.binary()))
        else:
            arrays.append(pa.nulls(len(values), pa.binary()))
    return pa.record_batch(arrays, names=["kind", "bucket", *COLUMNS])


def _spans_batch(spans: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    cols = dict(zip(SPAN, spans))
    where = _bucket(T.mix(cols["doc"].view(np.uint64)), buckets)
    return _dealt(SPANS, where, cols, SPAN)


def _asked_batch(cols: dict, buckets: int) -> pa.RecordBatch:
    return _dealt(ASKED, _bucket(cols["key"], buckets), cols, RUN)


def _empty() -> pa.RecordBatch:
    return _dealt(RUNS, np.zeros(0, np.int64), {c: np.zeros(0, k) for c, k in RUN.items()}, RUN)


# ---- arrays and levels ---------------------------------------------------------

def suffix_array(batch: DataFrame, buckets: int, length: int, key: int) -> DataFrame:
    """The suffix array of a batch, one row per bucket, with what it settles by itself."""

    def mark(batches):
        marker, held, count = Marker(length, key), [], 0

        def flush():
            cols = _joined(held)
            later, first = _again(cols)
            if later.any():
                yield _spans_batch(_merge_spans(*_run_spans(_picked(cols, later), length)), buckets)
            first = _picked(cols, first)
            yield _dealt(RUNS, _bucket(first["key"], buckets), first, RUN)

        for batch in batches:
            docs, text_keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in T.blocks(batch.column(2), LOOK_BYTES):
                runs = marker.runs(block)
                row = block.first + runs.row
                held.append({"key": runs.key, "whole": runs.whole, "doc": docs[row],
                             "text_key": text_keys[row],
                             "start": (runs.start - block.offsets[runs.row]).astype(np.int32),
                             "strings": runs.strings.astype(np.uint16)})
                count += len(row)
                if count >= HELD:
                    yield from flush()
                    held, count = [], 0
        if count:
            yield from flush()

    def gather(parts):
        for group in sorted_groups(parts, 2):
            if group.column(0)[0].as_py() == SPANS:
                yield group
                continue
            cols = _read(group, RUN)
            later, first = _again(cols)
            if later.any():
                yield _spans_batch(_merge_spans(*_run_spans(_picked(cols, later), length)), buckets)
            first = _picked(cols, first)
            asked = _mixed(first["key"])
            if len(asked):
                yield _asked_batch(_picked(first, asked), buckets)
            yield _dealt(RUNS, np.full(len(first["key"]), group.column(1)[0].as_py()), first, RUN)

    return (batch.select("doc", "text_key", "text").mapInArrow(mark, DEALT)
            .repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
            .mapInArrow(gather, DEALT))


class SuffixFamily:
    """Levels of suffix arrays over the batches added so far; later batches come later in order."""

    def __init__(self, spark: SparkSession, buckets: int, length: int = LENGTH, key: int = KEY) -> None:
        self.spark, self.buckets, self.length, self.key = spark, buckets, length, key
        self.levels: list[tuple[int, str]] = []
        self.name = f"suffix_{uuid.uuid4().hex}"
        self.folders: dict[str, str] = {}  # of all tables ever made

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch (doc, text_key, text); returns the spans and the runs asked for.

        The rows are what the batch repeats of itself and of everything before it.
        """
        name = self._store(suffix_array(batch, self.buckets, self.length, self.key))
        found = self.spark.table(name).where(F.col("kind") != RUNS).select("kind", "bucket", *COLUMNS)
        for _, level in self.levels:
            found = found.union(self._against(name, level))
        found = materialize(found, "suffix-matches")
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, other = self.levels.pop()
            merged = self._store(self._pairs(other, name, _merger()))
            self._drop(other, name)
            name, rank = merged, rank + 1
        self.levels.append((rank, name))
        return found

    def drop(self) -> None:
        """Delete all levels, and what an interrupted ``add`` has left."""
        self._drop(*self.folders)
        self.levels = []

    def _store(self, df: DataFrame) -> str:
        name = f"{self.name}_{len(self.folders)}"
        self.folders[name] = shared_dir(self.spark, name)
        (df.write.partitionBy("kind").bucketBy(self.buckets, "bucket").sortBy("bucket")
         .format("parquet").option("parquet.enable.dictionary", "false")
         .option("path", self.folders[name]).saveAsTable(name))
        return name

    def _against(self, name: str, level: str) -> DataFrame:
        return self._pairs(level, name, _scanner(self.length, self.buckets))

    def _pairs(self, left: str, right: str, fn) -> DataFrame:
        """Apply fn to the two tables' parts of each bucket; no exchange, as both are bucketed."""
        runs = lambda name: (self.spark.table(name).where(F.col("kind") == RUNS)
                             .select("kind", "bucket", *COLUMNS).groupBy("bucket"))
        return runs(left).cogroup(runs(right)).applyInArrow(fn, DEALT)

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_folder(self.spark, self.folders[name])


def _scanner(length: int, buckets: int):
    def scan(old: pa.Table, new: pa.Table) -> pa.Table:
        """Runs of the new array that an older one has too, and those whose beginning it has."""
        before, after = _read(old, RUN), _read(new, RUN)
        shared = _held(before["key"], after["key"]), _held(after["key"], before["key"])
        if not shared[0].any():
            return pa.Table.from_batches([_empty()])
        before, after = _picked(before, shared[1]), _picked(after, shared[0])
        pair = np.concatenate
        order = np.lexsort((np.repeat([0, 1], [len(before["key"]), len(after["key"])]),
                            pair([before["whole"], after["whole"]]), pair([before["key"], after["key"]])))
        key, whole = pair([before["key"], after["key"]])[order], pair([before["whole"], after["whole"]])[order]
        head = np.append(True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1]))
        old_first = order[np.flatnonzero(head)] < len(before["key"])
        known = np.empty(len(order), dtype=bool)
        known[order] = old_first[np.cumsum(head) - 1]
        known = known[len(before["key"]):]
        out = []
        if known.any():
            out.append(_spans_batch(_merge_spans(*_run_spans(_picked(after, known), length)), buckets))
        asking = _picked(after, ~known)
        if len(asking["key"]):
            answer = _picked(before, _held(asking["key"], before["key"]))
            out.append(_asked_batch(_joined([asking, answer]), buckets))
        return pa.Table.from_batches(out)

    return scan


def _merger():
    def merge(old: pa.Table, new: pa.Table) -> pa.Table:
        parts = [t for t in (old, new) if t.num_rows]
        cols = _joined([_read(t, RUN) for t in parts])
        _, first = _again(cols)
        bucket = parts[0].column("bucket")[0].as_py()
        return pa.Table.from_batches(
            [_dealt(RUNS, np.full(len(first), bucket), _picked(cols, first), RUN)])

    return merge


# ---- the table's own repeats ---------------------------------------------------

def asked_bytes(rows: DataFrame, asked: DataFrame, buckets: int, length: int, key: int) -> DataFrame:
    """The runs asked for with their bytes, dealt by key, or as strings where a key is crowded."""

    def fetch(batches):
        marker = Marker(length, key)
        for batch in batches:
            lists = batch.column(4)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            cols = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("key", "whole", "start", "strings")}
            cols = {"key": cols["key"].view(np.uint64), "whole": cols["whole"].view(np.uint64),
                    "doc": batch.column(0).to_numpy()[owner], "text_key": batch.column(1).to_numpy()[owner],
                    "start": cols["start"].astype(np.int32), "strings": cols["strings"].astype(np.uint16)}
            crowd = np.asarray(flat.field("crowd").to_numpy(zero_copy_only=False), dtype=bool)
            text, offsets = T.utf8(batch.column(3))
            begin = offsets[owner] + cols["start"]
            end = begin + cols["strings"] - 1 + length
            for at in range(0, len(owner), HELD // 8):
                some = slice(at, at + HELD // 8)
                data = [text[a:b].tobytes() for a, b in zip(begin[some].tolist(), end[some].tolist())]
                part, full = _picked(cols, some), crowd[some]
                few, many = np.flatnonzero(~full), np.flatnonzero(full)
                if len(few):
                    mine = _picked(part, few)
                    yield _dealt(RUNS, _bucket(mine["key"], buckets), mine, RUN, [data[i] for i in few.tolist()])
                for low in range(0, len(many), COMPARED // 64):
                    mine = many[low:low + COMPARED // 64]
                    joined = np.frombuffer(b"".join([data[i] for i in mine.tolist()]), np.uint8)
                    mine = _picked(part, mine)
                    first = np.concatenate([[0], np.cumsum(mine["strings"].astype(np.int64) + length - 1)])[:-1]
                    found = _strings(marker, mine, joined, first)
                    again, once = _again(found)
                    if again.any():
                        yield _spans_batch(_merge_spans(*_string_spans(_picked(found, again), length)), buckets)
                    found = _picked(found, once)
                    yield _dealt(STRINGS, _bucket(found["whole"], buckets), found, STRING)

    wanted = asked.groupBy("doc", "text_key").agg(
        F.collect_list(F.struct("key", "whole", "start", "strings", "crowd")).alias("runs"))
    return (rows.join(wanted.hint("shuffle_hash"), ["doc", "text_key"])
            .select("doc", "text_key", "doc_id", "text", "runs").mapInArrow(fetch, DEALT))


def _unpack(batches):
    for batch in batches:
        cols = _read(batch, RUN)
        yield pa.record_batch([pa.array(cols["key"].view(np.int64)), pa.array(cols["whole"].view(np.int64)),
                               pa.array(cols["doc"]), pa.array(cols["text_key"]), pa.array(cols["start"]),
                               pa.array(cols["strings"].astype(np.int32))], names=list(RUN))


def duplicate_spans(rows: DataFrame, length: int = LENGTH, key: int = KEY, batches: int = BATCHES,
                    hot: int = HOT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc, text_key, starts, ends): merged spans of repeated bytes of each document that has any."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 8
    while buckets * bucket_bytes < size and buckets < 1 << 20:
        buckets *= 2
    cuts = (rows.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01)
            if batches > 1 else [])
    cuts = sorted({min(int(c), int(LARGEST) - 1) for c in cuts})
    family = SuffixFamily(rows.sparkSession, buckets, length, key)
    found = None
    try:
        for low, high in zip([None, *cuts], [*cuts, None]):
            batch = rows
            if low is not None:
                batch = batch.where(F.col("doc") > low)
            if high is not None:
                batch = batch.where(F.col("doc") <= high)
            matches = family.add(batch)
            found = matches if found is None else found.union(matches)
    finally:
        family.drop()
    asked = materialize(found.where(F.col("kind") == ASKED).select(*RUN).mapInArrow(
        _unpack, "key long, whole long, doc long, text_key long, start int, strings int")
        .distinct(), "suffix-asked")
    crowds = materialize(asked.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= hot)
                         .select("key", F.lit(True).alias("crowd")), "suffix-crowds")
    asked = asked.join(crowds, "key", "left").withColumn("crowd", F.coalesce("crowd", F.lit(False)))
    dealt = found.where(F.col("kind") == SPANS).union(
        asked_bytes(rows, asked, buckets, length, key))

    def settle(parts):
        marker = Marker(length, key)
        for group in sorted_groups(parts, 2):
            kind = group.column(0)[0].as_py()
            if kind == SPANS:
                yield group
                continue
            if kind == RUNS:
                data = np.frombuffer(b"".join(group.column("bytes").to_pylist()), np.uint8)
                spans = _compare(marker, _read(group, RUN), data)
            else:
                cols = _read(group, STRING)
                spans = _merge_spans(*_string_spans(_picked(cols, _again(cols)[0]), length))
            if len(spans[0]):
                yield _spans_batch(spans, buckets)

    def unite(parts):
        for group in sorted_groups(parts, 1):
            doc, text_key, start, end = _merge_spans(*_read(group, SPAN).values())
            head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (text_key[1:] != text_key[:-1])))
            offsets = np.append(head, len(doc)).astype(np.int32)
            for at in range(0, len(head), 10_000):
                some = head[at:at + 10_000]
                bounds = offsets[at:at + len(some) + 1]
                lo, hi = int(bounds[0]), int(bounds[-1])
                lists = [pa.ListArray.from_arrays(pa.array(bounds - lo), pa.array(c[lo:hi].astype(np.int64)))
                         for c in (start, end)]
                yield pa.record_batch([pa.array(doc[some]), pa.array(text_key[some]), *lists],
                                      names=["doc", "text_key", "starts", "ends"])

    settled = (dealt.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
               .mapInArrow(settle, DEALT))
    return (settled.select("bucket", *SPAN).repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(unite, "doc long, text_key long, starts array<long>, ends array<long>"))


def remove_repeats(documents: DataFrame, length: int = LENGTH, key: int = KEY,
                   batches: int = BATCHES, hot: int = HOT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document row: bytes, bytes and spans removed, and the digest of the kept bytes."""
    rows = _ordered(documents)
    spans = duplicate_spans(rows, length, key, batches, hot, bucket_bytes)

    def cut(parts):
        for batch in parts:
            starts, ends = batch.column(2), batch.column(3)
            at, to = starts.offsets.to_numpy(), starts.offsets.to_numpy()[1:]
            s, e = starts.values.to_numpy(), ends.values.to_numpy()
            shift = ends.offsets.to_numpy()[0] - at[0] if len(at) else 0
            n, removed, pieces, digest = [], [], [], []
            data, offsets = T.utf8(batch.column(1))
            raw = memoryview(data)
            for r in range(batch.num_rows):
                lo, hi = int(offsets[r]), int(offsets[r + 1])
                hasher, place, gone = hashlib.sha256(), lo, 0
                for i in range(int(at[r]), int(to[r])):
                    a, b = lo + int(s[i]), lo + int(e[i + shift])
                    hasher.update(raw[place:a])
                    gone += b - a
                    place = b
                hasher.update(raw[place:hi])
                n.append(hi - lo)
                removed.append(gone)
                pieces.append(int(to[r]) - int(at[r]))
                digest.append(hasher.hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(pieces, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    none = F.array().cast("array<long>")
    # both joins read the rows dealt by (doc, text_key), which Spark deals once
    return (rows.join(spans.hint("shuffle_hash"), ["doc", "text_key"], "left")
            .select("doc_id", "text", F.coalesce("starts", none).alias("starts"),
                    F.coalesce("ends", none).alias("ends"))
            .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
