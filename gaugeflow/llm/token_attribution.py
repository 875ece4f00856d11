"""Token counts by offset-mapped attribution.

A whole document is encoded once. Its tokens' spans are joined to the spans of its
sections (lines with their line break, or fields in their order), and a token that
crosses a boundary is given away by a stated rule: "start" to the section of its
first byte, "end" to that of its last, "majority" to the section with most of its
bytes (the earlier one of equals), "split" to all in proportion to their bytes.
Counting sections one by one would differ, as pieces at a boundary are cut anew.

Null and empty texts have one empty section without tokens. Repeated rows give
repeated results. Other columns are ignored.

Spans of tokens and sections of a block are both sorted, so the join is a binary
search; nothing is shuffled, and memory follows a block of a few megabytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import text as T
from gaugeflow.llm.bpe import Encoded, char_classes, encoder

RULES = ("start", "end", "majority", "split")


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section; sections are the ranges between the sorted bounds, none empty."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    sections = len(bounds) - 1
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    if rule == "end":
        return np.bincount(last, minlength=sections).astype(np.float64)
    if rule == "start":
        return np.bincount(first, minlength=sections).astype(np.float64)
    inside = first == last
    out = np.bincount(first[inside], minlength=sections).astype(np.float64)
    for i in np.flatnonzero(~inside).tolist():
        span = np.arange(first[i], last[i] + 1)
        share = (np.minimum(ends[i], bounds[span + 1]) - np.maximum(starts[i], bounds[span])).astype(np.float64)
        if rule == "majority":
            out[span[np.argmax(share)]] += 1
        else:
            out[span] += share / share.sum()
    return out


def line_bounds(block: T.Block) -> np.ndarray:
    """First bytes of all lines of all texts, and the end; empty texts have none."""
    breaks = np.flatnonzero(block.data == 10) + 1
    bounds = np.union1d(breaks, block.offsets)
    return bounds.astype(np.int64)


def line_tokens(documents: DataFrame, path: str, rule: str = "majority") -> DataFrame:
    """(doc_id, section, first_char, n_chars, n_tokens, n_crossing) per line of every text.

    n_crossing counts the tokens that begin in the line and end in a later one.
    """
    held = documents.sparkSession.sparkContext.broadcast((encoder(path), char_classes()))

    def run(batches):
        model, classes = held.value
        for batch in batches:
            for block in T.blocks(batch.column(1)):
                done = Encoded(model, classes, block)
                per_piece = np.diff(done.places)
                pieces = done.piece
                counts = per_piece[pieces]
                at = np.repeat(done.places[pieces] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
                sizes = model.lengths[done.ids[at + np.arange(len(at))]]
                ends = np.cumsum(sizes, dtype=np.int64)
                starts = ends - sizes
                bounds = line_bounds(block)
                sections = len(bounds) - 1
                if len(starts):
                    tokens = allocate(starts, ends, bounds, rule)
                    first = np.searchsorted(bounds, starts, side="right") - 1
                    crossing = np.bincount(first[ends > bounds[first + 1]], minlength=sections)
                else:
                    tokens, crossing = np.zeros(sections), np.zeros(sections, np.int64)
                chars = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                row = np.searchsorted(block.offsets, bounds[:-1], side="right") - 1
                number = np.arange(sections) - np.searchsorted(bounds, block.offsets[row])
                begin = chars[bounds[:-1]] - chars[block.offsets[row]]
                width = chars[bounds[1:]] - chars[bounds[:-1]]
                empty = np.flatnonzero(np.diff(block.offsets) == 0)
                zeros = np.zeros(len(empty), np.int64)
                join = lambda a, b=zeros: np.concatenate([a, b])
                ids = batch.column(0).take(pa.array(block.first + join(row, empty)))
                yield pa.record_batch(
                    [ids, pa.array(join(number)), pa.array(join(begin)), pa.array(join(width)),
                     pa.array(join(tokens, zeros.astype(np.float64))), pa.array(join(crossing))],
                    names=["doc_id", "section", "first_char", "n_chars", "n_tokens", "n_crossing"])

    return (documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, section long, first_char long, n_chars long, "
                             "n_tokens double, n_crossing long"))


def field_tokens(documents: DataFrame, fields: list[str], path: str, rule: str = "majority",
                 glue: str = "\n") -> DataFrame:
    """The documents with n_tokens_<field>: tokens of the joined fields, given to each field.

    The glue after a field belongs to it. Null fields are empty and get nothing.
    """
    held = documents.sparkSession.sparkContext.broadcast((encoder(path), char_classes()))
    source = [F.concat(F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")),
                       F.lit(glue if i < len(fields) - 1 else "")).alias(f"f{i}")
              for i, f in enumerate(fields)]
    kept = [c for c in documents.columns if c not in {f"n_tokens_{f}" for f in fields}]
    base = documents.select(*[F.col(f"`{c}`") for c in kept])
    schema = type(base.schema)(list(base.schema.fields))
    for f in fields:
        schema = schema.add(f"n_tokens_{f}", "double")
    whole = documents.select(*[F.col(f"`{c}`") for c in kept],
                             F.array(*source).alias("_parts"), F.concat(*source).alias("_whole"))

    def run(batches):
        model, classes = held.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            parts = batch.column(batch.num_columns - 2)
            for block in T.blocks(texts):
                done = Encoded(model, classes, block)
                out = np.zeros((block.rows, len(fields)))
                for r in range(block.rows):
                    ids = np.concatenate([done.ids[done.places[p]:done.places[p + 1]]
                                          for p in done.piece[done.bounds[r]:done.bounds[r + 1]]]
                                         or [np.zeros(0, np.int32)])
                    ends = np.cumsum(model.lengths[ids], dtype=np.int64)
                    sizes = np.array([len(x.encode()) for x in parts[block.first + r].as_py()])
                    full = np.flatnonzero(sizes)
                    if len(ids):
                        bounds = np.concatenate([[0], np.cumsum(sizes[full])])
                        out[r, full] = allocate(ends - model.lengths[ids], ends, bounds, rule)
                part = batch.slice(block.first, block.rows)
                yield pa.record_batch(
                    [part.column(i) for i in range(part.num_columns - 2)]
                    + [pa.array(out[:, i]) for i in range(len(fields))], names=schema.names)

    return whole.mapInArrow(run, schema)
