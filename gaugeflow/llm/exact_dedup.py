"""Exact deduplication by progressive refinement: length, then prefix, then full content.

Texts are equal when they are identical after every run of white space (space, tab and the
line breaks 0x0A to 0x0D) has become one space. The texts are read once for the two cheap
keys, 16 bytes a row. Rows whose length nobody shares are out; of the others those whose
(length, prefix) nobody shares are out; only what is left can have an equal and is hashed
whole. Both steps count with a combiner, so one length that a third of all rows have is one
row per task, and hand on a filter of bounded size, which may let a few more rows pass: the
last step decides by SHA-256. No text is moved; only digests are, and the rows of large
groups meet their group by a broadcast of at most ``HEAVY`` groups.

Null texts count as empty, so null and empty texts are equal. Null ids come after all
others. Of rows with equal text and equal id one stays. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from gaugeflow.llm import text as T
from gaugeflow.llm.keyfilter import KeyFilter, build_filter
from gaugeflow.llm.names import free_name
from gaugeflow.session import materialize

#: Bytes of the prefix that is hashed.
PREFIX = 256
#: A group of more than 1 / HEAVY of all rows is heavy; there are fewer than HEAVY of them.
HEAVY = 4096
WHITE_RUN = "[\\x20\\x09-\\x0D]+"


def normalised(column: pa.Array) -> pa.Array:
    """The texts as bytes with each run of white space as one space; null is empty."""
    return pc.replace_substring_regex(
        pc.fill_null(column, "").cast(pa.large_string()), WHITE_RUN, " ").cast(pa.large_binary())


def _pieces(batches, texts: str):
    """Rows of a batch in runs of bounded bytes, with their normalised texts."""
    for batch in batches:
        column = batch.column(texts)
        for block in T.blocks(column):
            rows = slice(block.first, block.last)
            piece = batch.slice(rows.start, rows.stop - rows.start)
            yield piece, normalised(piece.column(texts))


def _keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Length in bytes, and a hash of length and prefix."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    digests = b"".join(hashlib.blake2b(t[:PREFIX], digest_size=8).digest()
                       for t in pc.binary_slice(texts, 0, PREFIX).to_pylist())
    prefix = np.frombuffer(digests, np.uint64)
    return lengths, T.mix(prefix + T.mix(lengths.view(np.uint64))).view(np.int64)


def _cheap_keys(docs: DataFrame, text: str) -> DataFrame:
    def keys(batches):
        for _, texts in _pieces(batches, "text"):
            lengths, prefixes = _keys(texts)
            yield pa.record_batch({"length": lengths, "prefix": prefixes})

    return docs.select(F.col(text).alias("text")).mapInArrow(keys, "length long, prefix long")


def _shared(rows: DataFrame, key: str) -> KeyFilter:
    """A filter of the keys that more than one row has."""
    shared = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    return build_filter(materialize(shared, f"dedup-{key}"), key)


def survivors_filter(docs: DataFrame, text: str = "text") -> KeyFilter:
    """The (length, prefix) keys that several rows have; few others pass."""
    cheap = materialize(_cheap_keys(docs, text), "dedup-keys")
    lengths = _shared(cheap, "length")

    def sharing(batches):
        for batch in batches:
            yield batch.filter(pa.array(lengths.passes(batch.column("length").to_numpy())))

    return _shared(cheap.mapInArrow(sharing, cheap.schema), "prefix")


def _digested(docs: DataFrame, text: str, alike: KeyFilter, digest_all: bool,
              names: tuple[str, str]) -> DataFrame:
    """The rows with a flag for those that may have an equal, and the digest of their text."""
    own, hit, digest = text, *names

    def hashed(batches):
        for piece, texts in _pieces(batches, own):
            passes = alike.passes(_keys(texts)[1])
            values = [hashlib.sha256(t.as_py()).hexdigest() if digest_all or p else None
                      for t, p in zip(texts, passes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(passes), pa.array(values, pa.string())],
                names=[*piece.schema.names, hit, digest])

    schema = StructType([*docs.schema.fields, StructField(hit, BooleanType()),
                         StructField(digest, StringType())])
    return docs.mapInArrow(hashed, schema)


def mark_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    columns: list[str] | None = None, digest_all: bool = True) -> DataFrame:
    """``columns`` of every row (its id alone, if none are named) with ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256``.

    Without ``digest_all`` only rows that may have an equal have a digest. An empty table
    gives an empty result. Named columns must not be called like the four new ones.
    """
    columns = columns or [doc_id]
    alike = survivors_filter(docs, text)
    taken = {c.lower() for c in columns} | {text.lower(), doc_id.lower(), "keep_id", "group_size",
                                            "kept", "text_sha256"}
    hit, row, dearest, body = (free_name(n, taken) for n in ("_alike", "_row", "_first", "_body"))
    source = docs.select(*[F.col(c) for c in columns],
                         *([F.col(doc_id)] if doc_id not in columns else []),
                         F.col(text).alias(body))
    out = _digested(source, body, alike, digest_all, (hit, "text_sha256"))
    # row numbers are settled by writing the rows down
    rows = materialize(out.drop(body).withColumn(row, F.monotonically_increasing_id()), "dedup-rows")
    order = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(row))
    groups = materialize(
        rows.where(hit).groupBy("text_sha256").agg(
            F.min(order).alias(dearest), F.count("*").alias("group_size")).where("group_size > 1"),
        "dedup-groups")
    heavy = F.col("group_size") * F.lit(HEAVY) > F.lit(max(rows.count(), 1))
    in_heavy = rows.join(F.broadcast(groups.where(heavy)), "text_sha256", "left")
    done = F.col(dearest).isNotNull() | ~F.col(hit)
    rest = in_heavy.where(~done).drop(dearest, "group_size").join(
        groups.where(~heavy), "text_sha256", "left")
    found = in_heavy.where(done).unionByName(rest)
    alone = F.col(dearest).isNull()
    first = F.col(dearest)
    return found.select(
        *columns,
        F.when(alone, F.col(doc_id)).otherwise(first[doc_id]).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (first[row] == F.col(row))).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, inner))
    marked = mark_duplicates(docs.toDF(*inner), names[text], names[doc_id], inner, digest_all=False)
    return marked.where("kept").select(*[F.col(i).alias(c) for c, i in names.items()])
