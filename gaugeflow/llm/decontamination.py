"""Benchmark decontamination by winnowing.

Of every `span - gram + 1` consecutive word k-grams the one with the smallest
hash is kept as a fingerprint, so two texts that share `span` words share a
fingerprint. Documents meet the benchmark on fingerprints, each hit is extended
to the windows of `span` words around it, and windows are compared as text, so
neither hash collisions nor the filter can change the result. Items of fewer
words are a window of their own length, fingerprinted by all n-grams of that
length (winnowing with a window of one).

Rows: null and empty texts have no words and no hits; a null item_id adds hits
but is no counted item; repeated item rows count once, repeated document rows
each give a row. Other columns are ignored. An empty benchmark hits nothing.

At scale: the benchmark's fingerprints reach the tasks as a filter of bounded
size, so the documents are scanned once and only windows around hits are
shuffled. All windows of one document meet in one group, never those of a
passage or an item.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import text as T
from gaugeflow.llm.keyfilter import build_filter
from gaugeflow.session import materialize

#: Words that a shared passage needs to be found for certain.
SPAN = 10
#: Words of a fingerprinted k-gram.
GRAM = 5
#: Windows of one document in one row.
CHUNK = 2048

WINDOW = "array<struct<start:bigint,words:int,phrase:string>>"


def winnow(found: T.Words, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a block: the rightmost smallest k-gram of each window, and its place."""
    hashes, places = T.row_ngrams(found, gram)
    width = span - gram + 1
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    best, at = hashes[:count].copy(), np.zeros(count, np.int64)
    for j in range(1, width):
        lower = hashes[j:j + count] <= best
        best[lower] = hashes[j:j + count][lower]
        at[lower] = j
    within = places[:count] + span <= found.row_ends()[places[:count]]
    chosen = np.unique((np.arange(count) + at)[within])
    return hashes[chosen], places[chosen]


def _phrases(block: T.Block, found: T.Words, places: np.ndarray, n: int) -> list[bytes]:
    data = T.lower_table()[block.data].tobytes()
    starts, ends = found.starts, found.ends
    return [b" ".join([data[a:b] for a, b in zip(starts[i:i + n].tolist(), ends[i:i + n].tolist())])
            for i in places.tolist()]


def _short_keys(found: T.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    return T.row_ngrams(found, n, seed=100 + n)


def item_windows(benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Every window of every item as text, with the item's fingerprints on its first row."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in T.blocks(batch.column(1)):
                found = T.words(block)
                prints, at = winnow(found, gram, span)
                row_of = np.searchsorted(found.offsets, at, side="right") - 1
                out = []
                for r in range(block.rows):
                    lo, hi = found.offsets[r], found.offsets[r + 1]
                    n = int(min(hi - lo, span))
                    if not n:
                        continue
                    item = ids[block.first + r].as_py()
                    keys = prints[row_of == r]
                    if n < span:
                        keys = T.ngrams(found.hashes[lo:hi], n, seed=100 + n)
                    places = np.arange(lo, hi - n + 1)
                    for i in range(0, len(places), CHUNK):
                        out.append((item, n, _phrases(block, found, places[i:i + CHUNK], n),
                                    keys.view(np.int64) if i == 0 else []))
                if out:
                    yield pa.record_batch(
                        [pa.array([x[0] for x in out], pa.int64()),
                         pa.array([x[1] for x in out], pa.int32()),
                         pa.array([x[2] for x in out], pa.list_(pa.string())),
                         pa.array([list(x[3]) for x in out], pa.list_(pa.int64()))],
                        names=["item_id", "words", "phrases", "prints"])

    return (benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "item_id long, words int, phrases array<string>, prints array<long>"))


def candidate_windows(documents: DataFrame, keys, short: list[int], span: int = SPAN,
                      gram: int = GRAM) -> DataFrame:
    """Per document its number of words and the windows around fingerprint hits.

    A document with many windows spreads over several rows; the first has n_words.
    """
    held = documents.sparkSession.sparkContext.broadcast(keys.bits)

    def run(batches):
        from gaugeflow.llm.keyfilter import KeyFilter

        keys = KeyFilter(held.value)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int32()),
                                   ("phrase", pa.string())]))
        for batch in batches:
            for block in T.blocks(batch.column(3)):
                found = T.words(block)
                total = len(found.starts)
                ends = found.row_ends()
                prints, at = winnow(found, gram, span)
                hits = at[keys.passes(prints)]
                near = (hits[:, None] - np.arange(span - gram + 1)[None, :]).ravel()
                near = np.unique(near[near >= 0])
                near = near[near + span <= ends[near]] if total else near
                # the window must lie in the row of its hit
                wanted = [(near, span)]
                for n in short:
                    prints, at = _short_keys(found, n)
                    wanted.append((at[keys.passes(prints)], n))
                rows, starts, sizes, phrases = [], [], [], []
                for places, n in wanted:
                    if len(places):
                        row = np.searchsorted(found.offsets, places, side="right") - 1
                        rows.append(row)
                        starts.append(places - found.offsets[row])
                        sizes.append(np.full(len(places), n))
                        phrases += _phrases(block, found, places, n)
                windows: dict[int, list] = {}
                if rows:
                    for r, s, n, p in zip(np.concatenate(rows).tolist(),
                                          np.concatenate(starts).tolist(),
                                          np.concatenate(sizes).tolist(), phrases):
                        windows.setdefault(r, []).append(
                            {"start": s, "words": n, "phrase": p.decode("utf-8", "replace")})
                source, count, lists = [], [], []
                sizes = np.diff(found.offsets).tolist()
                for r in range(block.rows):
                    mine = windows.get(r, [])
                    for i in range(0, max(len(mine), 1), CHUNK):
                        source.append(block.first + r)
                        count.append(sizes[r] if i == 0 else None)
                        lists.append(mine[i:i + CHUNK])
                take = pa.array(source, pa.int64())
                yield pa.record_batch(
                    [*[batch.column(i).take(take) for i in range(3)],
                     pa.array(count, pa.int64()), pa.array(lists, kind)],
                    names=["row", "doc_id", "text_key", "n_words", "windows"])

    text = F.col("text").cast("string")
    return (documents.select(F.monotonically_increasing_id().alias("row"),
                             F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"),
                             text.alias("text"))
            .mapInArrow(run, f"row long, doc_id long, text_key long, n_words long, windows {WINDOW}"))


def _scan(documents: DataFrame, benchmark: DataFrame, span: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """The scanned documents, and the distinct (item_id, phrase) of the benchmark."""
    items = materialize(item_windows(benchmark, span, gram), "decontamination-items")
    short = [r.words for r in items.where(F.col("words") < span).select("words")
             .distinct().collect()]
    keys = build_filter(items.select(F.explode("prints").alias("print")), "print")
    scanned = materialize(candidate_windows(documents, keys, sorted(short), span, gram),
                          "decontamination-windows")
    return scanned, items.select("item_id", F.explode("phrases").alias("phrase")).distinct()


def without_contaminated(documents: DataFrame, benchmark: DataFrame, span: int = SPAN,
                         gram: int = GRAM) -> DataFrame:
    """The document rows, with all their columns, in which no window of the benchmark stands."""
    scanned, owners = _scan(documents, benchmark, span, gram)
    hit = materialize(
        scanned.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"),
                       F.inline("windows"))
        .join(owners.select("phrase").distinct(), "phrase", "left_semi")
        .select("hit_id", "hit_key").distinct(), "decontamination-hits")
    same = (documents["doc_id"].cast("long").eqNullSafe(hit["hit_id"])
            & (F.xxhash64(documents["text"].cast("string")) == hit["hit_key"]))
    return documents.join(hit, same, "left_anti")


def contamination(documents: DataFrame, benchmark: DataFrame, span: int = SPAN,
                  gram: int = GRAM) -> DataFrame:
    """One row per document row: words, words hit, items found and their digest."""
    scanned, owners = _scan(documents, benchmark, span, gram)
    windows = scanned.select("row", F.inline("windows"))
    hits = windows.join(owners.select("phrase").distinct(), "phrase", "left_semi")
    order = Window.partitionBy("row").orderBy("start", "words")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = F.col("start") + F.col("words")
    covered = (hits.select("row", "start", "words",
                           F.coalesce(F.max(ends).over(before), F.lit(0)).alias("reached"))
               .groupBy("row")
               .agg(F.sum(F.greatest(ends - F.greatest("start", "reached"), F.lit(0)))
                    .alias("n_hit")))
    found = (windows.join(owners.where("item_id IS NOT NULL"), "phrase")
             .select("row", "item_id").distinct().groupBy("row")
             .agg(F.count("*").alias("n_items"),
                  F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",")
                  .alias("items")))
    return (scanned.where("n_words IS NOT NULL").select("row", "doc_id", "n_words")
            .join(covered, "row", "left").join(found, "row", "left")
            .select("doc_id", "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
