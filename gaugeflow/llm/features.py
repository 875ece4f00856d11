"""Dense features of whole texts, computed per block, and bounded training samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import text as T

#: Labelled rows that a classifier is fitted on, at most.
SAMPLE_ROWS = 20_000


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a value per byte or word over each row's range."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


def classes() -> dict[str, np.ndarray]:
    """Byte classes that the structure statistics count."""
    return {
        "upper": _class((65, 90)), "letter": _class((65, 90), (97, 122), (128, 255)),
        "digit": _class((48, 57)), "exclaim": _class((33, 33), (63, 63)),
        "symbol": _class((35, 38), (42, 43), (60, 62), (64, 64), (91, 96), (123, 126)),
        "mark": _class((33, 33), (39, 41), (44, 47), (58, 59), (63, 63)),
        "space": _class((9, 13), (32, 32)), "line": _class((10, 10)),
    }


def byte_counts(block: T.Block) -> np.ndarray:
    """How often each byte value stands in each row."""
    rows = np.repeat(np.arange(block.rows) * 256, np.diff(block.offsets))
    rows += block.data
    return np.bincount(rows, minlength=block.rows * 256).reshape(block.rows, 256)


def _row_sums(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the sorted places lie in each row."""
    return np.diff(np.searchsorted(places, offsets)).astype(np.float64)


def structure(block: T.Block, found: T.Words) -> dict[str, np.ndarray]:
    """Rates of byte classes, word shapes, repetition and size, each between 0 and about 1."""
    data, offsets = block.data, block.offsets
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    count = np.diff(found.offsets)
    n_words = np.maximum(count, 1).astype(np.float64)
    kinds = classes()
    bytes_of = byte_counts(block)
    total = {name: bytes_of[:, table].sum(axis=1).astype(np.float64) for name, table in kinds.items()}
    rate = {name: value / size for name, value in total.items()}
    thrice = np.flatnonzero((data[2:] == data[1:-1]) & (data[2:] == data[:-2])) + 2
    thrice = thrice[~kinds["space"][data[thrice]]]
    symbols = np.flatnonzero(kinds["symbol"][data])
    symbols = symbols[(symbols > 0) & (symbols < len(data) - 1)]
    inner = symbols[kinds["letter"][data[symbols - 1]] & kinds["letter"][data[symbols + 1]]]
    # letters, digits and capitals of a word from one running sum
    step = (kinds["letter"].astype(np.int64) + (kinds["digit"].astype(np.int64) << 21)
            + (kinds["upper"].astype(np.int64) << 42))
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(step[data], out=sums[1:])
    inside = sums[found.ends] - sums[found.starts]
    letters, digits, uppers = inside & 0x1FFFFF, inside >> 21 & 0x1FFFFF, inside >> 42
    length = found.ends - found.starts
    shout = (uppers == length) & (length > 1)
    mixed = (letters > 0) & (digits > 0)
    same = np.zeros(len(found.hashes), dtype=bool)
    same[1:] = found.hashes[1:] == found.hashes[:-1]
    # 40 bits of a word's hash tell the words of a row apart well enough for a rate
    rows = np.repeat(np.arange(block.rows, dtype=np.uint64), count)
    words = np.sort(rows << np.uint64(40) | found.hashes >> np.uint64(24))
    fresh = words[np.append(True, words[1:] != words[:-1])] if len(words) else words
    different = np.bincount((fresh >> np.uint64(40)).astype(np.int64), minlength=block.rows)
    share = lambda mask: per_row(mask, found.offsets) / n_words
    return {
        "upper": total["upper"] / np.maximum(total["letter"], 1),
        "shout": share(shout), "exclaim": np.minimum(rate["exclaim"] * 10, 1),
        "mark": np.minimum(rate["mark"] * 5, 1), "symbol": np.minimum(rate["symbol"] * 5, 1),
        "digit": rate["digit"], "inner": np.minimum(_row_sums(inner, offsets) / n_words, 1),
        "run": np.minimum(_row_sums(thrice, offsets) / n_words, 1), "mixed": share(mixed),
        "space": rate["space"], "line": np.minimum(rate["line"] * 20, 1), "repeat": share(same),
        "fresh": different / n_words, "words": np.log1p(count) / 12,
        "length": np.minimum(per_row(length, found.offsets) / n_words / 20, 1),
    }


def labelled_sample(labels: DataFrame, column: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most `rows` labelled ids outside the held-out fold, with the fold 1 to 4.

    The rows with the smallest hashes are taken, so the choice depends on the ids
    alone. Null ids and labels other than 0 and 1 take no part.
    """
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col(column).cast("double").alias("label"), fold("doc_id").alias("fold"))
            .where("fold > 0 AND label IN (0, 1)")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def fold(column: str):
    """crc32 of the id's text modulo 5; null ids count as fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("long").cast("string")) % 5, F.lit(0))


def labelled_texts(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """Texts of the sampled ids; the sample is bounded, so it may be broadcast."""
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.col("text").cast("string").alias("text"))
            .join(F.broadcast(sample), "doc_id").select("label", "fold", "text"))
