"""The prefix trie of conversations, from padded matrices of turn ids.

Conversations become rows of turn ids (128 bits of a SHA-256 over role and text) and are
dealt by range of their ids and conv_id, so that no shard depends on how common a beginning or
a whole conversation is. Within a shard the rows are a matrix, padded
with a value below all ids and sorted with numpy's lexsort; a row begins a node of depth d
where any of its first d columns differs from the row before (column changes, accumulated
by OR), and ``reduceat`` over those beginnings aggregates every depth. Deep conversations
are handled in bands of ``BAND`` columns, each with only the rows that reach it, so one long
conversation does not pad all others.

A node may go on in the next shard only if the last row here and the first row there share
its turns. Shards learn from their neighbours how many turns they share. Every number of a
node is a sum over rows, over nodes that begin here, or over nodes that end here, so nodes on
a border are recombined by adding up; all others are final.

Defined cases: rows without ``conv_id`` are no conversation and are left out; a null role or
text is empty; turns go by ``turn``, null first, equal numbers by the digest of role and text;
an empty table has no nodes, not even a root. A conversation is one row of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import materialize

#: Shared turns come from the first conversation of so many, and there are fewer than this.
FAMILY, SHARED = 100, 6
#: Columns of a matrix.
BAND = 64
#: Turns in a shard, about.
SHARD_TURNS = 200_000
#: Ids that are joined in one row.
CHUNK = 1 << 13
#: Border nodes that are broadcast; more are joined by shuffle.
BROADCAST_NODES = 200_000
PAD = np.iinfo(np.int64).min

NODE = ("shard int, key string, conv_id long, depth int, parent_key string, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long, chunk_from long, "
        "chunk string, ends_sha256 string")


def _half(digest: Column, start: int) -> Column:
    half = F.conv(F.substring(digest, start, 16), 16, -10).cast("long")
    return F.greatest(half, F.lit(int(PAD) + 1))  # the padding is below all ids


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: (turn, two halves of the id, code points)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = (conversations.where(F.col("conv_id").isNotNull())
             .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
                     F.length(text).cast("long").alias("size"))
             .select("conv_id", F.struct("turn", _half(F.col("digest"), 1).alias("high"),
                                         _half(F.col("digest"), 17).alias("low"), "size").alias("t")))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """Every conversation with its first turns taken from the first of its family."""
    own = materialize(turn_rows(conversations), "trie-turns")
    take = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    heads = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, shared - 1).alias("head"))
    joined = own.withColumns({"take": take, "first": F.col("conv_id") - F.col("conv_id") % family}
                             ).join(heads, "first", "left")
    none = F.slice("turns", 1, 0)
    return joined.select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("take")),
        F.slice("turns", F.col("take") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def trie_nodes(sequences: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie of (conv_id, turns); ids must be distinct.

    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    spark = sequences.sparkSession
    ids = F.flatten(F.transform("turns", lambda t: F.array(t["high"], t["low"])))
    rows = materialize(sequences.select(
        "conv_id", ids.alias("ids"), F.transform("turns", lambda t: t["size"]).alias("sizes")),
        "trie-rows")
    if shards is None:
        turns = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // SHARD_TURNS)
    dealt = materialize(rows.repartitionByRange(shards, "ids", "conv_id")
                        .withColumn("shard", F.spark_partition_id()), "trie-shards")
    borders = F.broadcast(_borders(dealt))  # a row per shard
    nodes = dealt.join(borders, "shard").groupBy("shard").applyInArrow(_shard_nodes, NODE)
    return _recombined(materialize(nodes, "trie-nodes"))


def _borders(dealt: DataFrame) -> DataFrame:
    """First and last row of a shard, and how many turns they share with the shards beside it."""
    ends = materialize(dealt.groupBy("shard").agg(
        F.min(F.struct("ids", "conv_id")).alias("low"),
        F.max(F.struct("ids", "conv_id")).alias("high")), "trie-ends")
    order = Window.orderBy("shard")  # a row per shard

    def shared(a: Column, b: Column) -> Column:
        same = F.zip_with(a["ids"], b["ids"], lambda x, y: F.coalesce(x == y, F.lit(False)))
        differs = F.array_position(same, F.lit(False))
        return F.coalesce(F.floor(F.when(differs > 0, differs - 1).otherwise(F.size(same)) / 2),
                          F.lit(-1)).cast("int")

    return ends.select(
        "shard", F.col("low.conv_id").alias("first"), F.col("high.conv_id").alias("last"),
        shared(F.lag("high").over(order), F.col("low")).alias("left"),
        shared(F.lead("low").over(order), F.col("high")).alias("right"))


class _Depth:
    """Nodes of one depth of a shard, in the order of their rows."""

    def __init__(self, parent, first, n_convs, conv, size, ends) -> None:
        self.parent, self.first, self.n_convs = parent, first, n_convs
        self.conv, self.size, self.ends = conv, size, ends
        nodes = len(first)
        self.opens_left, self.opens_right = np.zeros(nodes, bool), np.zeros(nodes, bool)
        self.children = np.zeros(nodes, np.int64)  # that begin here
        self.held = np.zeros(nodes, np.int64)  # that are here


def _depths(conv: np.ndarray, ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, marks: dict
            ) -> list[_Depth]:
    """The nodes of every depth. ``marks`` maps two rows to their nodes per depth, to be filled."""
    at = np.cumsum(lengths) - lengths
    root = _Depth(np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([len(conv)]),
                  np.array([conv.min()]), np.zeros(1, np.int64), [np.sort(conv[lengths == 0])])
    out = [root]
    for path in marks.values():
        path.append(0)
    rows, node, depth = np.flatnonzero(lengths > 0), np.zeros(len(conv), np.int64), 0
    while len(rows):
        width = min(BAND, int(lengths[rows].max()) - depth)
        column = np.arange(width)
        there = column[None, :] < (lengths[rows] - depth)[:, None]
        place = np.where(there, (at[rows] + depth)[:, None] + column[None, :], 0)
        matrix = np.full((len(rows), width, 2), PAD)
        matrix[there] = ids[place[there]]
        order = np.lexsort((conv[rows], *matrix[:, ::-1, ::-1].reshape(len(rows), -1).T, node[rows]))
        rows, matrix, there, place = rows[order], matrix[order], there[order], place[order]
        change = np.ones((len(rows), width + 1), bool)
        change[1:, 0] = node[rows[1:]] != node[rows[:-1]]
        change[1:, 1:] = (matrix[1:] != matrix[:-1]).any(axis=2)
        begins = np.logical_or.accumulate(change, axis=1)[:, 1:]
        for j in range(width):
            starts = np.flatnonzero(begins[:, j])
            real = there[starts, j]
            depth += 1
            count = np.diff(np.append(starts, len(rows)))[real]
            done = lengths[rows] == depth
            last = np.add.reduceat(done.astype(np.int64), starts)[real]
            least = np.minimum.reduceat(conv[rows], starts)[real]
            parent = node[rows[starts]][real]
            begin = starts[real]
            # rows that end in a node are in the order of their ids
            ends = np.split(conv[rows[done]], np.cumsum(last)[:-1])
            out.append(_Depth(parent, rows[begin], count, least, sizes[place[begin, j]], ends))
            inside = there[:, j]
            number = np.cumsum(begins[:, j] & inside) - 1
            node[rows[inside]] = number[inside]
            for row, path in marks.items():
                if lengths[row] >= depth:
                    path.append(int(node[row]))
        rows = rows[lengths[rows] > depth]
    return out


def _shard_nodes(table: pa.Table) -> pa.Table:
    """All nodes of a shard; those on a border as parts."""
    table = table.combine_chunks()
    conv = table.column("conv_id").to_numpy()
    held = table.column("ids").combine_chunks()
    ids = held.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
    sizes = table.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(held.offsets.to_numpy()) // 2
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    first = int(np.flatnonzero(conv == table.column("first")[0].as_py())[0])
    last = int(np.flatnonzero(conv == table.column("last")[0].as_py())[0])
    marks = {first: [], last: []}
    levels = _depths(conv, ids, sizes, lengths, marks)
    for depth, level in enumerate(levels):
        if depth <= left:
            level.opens_left[marks[first][depth]] = True
        if depth <= right:
            level.opens_right[marks[last][depth]] = True
        if depth:
            above = levels[depth - 1]
            np.add.at(above.children, level.parent, (~level.opens_left).astype(np.int64))
            np.add.at(above.held, level.parent, 1)
    at = np.cumsum(lengths) - lengths

    def keys(row: int, upto: int) -> list[str]:
        """Names of the border nodes on a row's path."""
        whole, out = hashlib.sha256(), []
        for depth in range(upto + 1):
            if depth:
                whole.update(ids[at[row] + depth - 1].tobytes())
            out.append(whole.hexdigest())
        return out

    paths = [(marks[first], keys(first, left)), (marks[last], keys(last, right))]
    shard = table.column("shard")[0].as_py()
    columns: dict[str, list] = {f.split()[0]: [] for f in NODE.split(", ")}

    def emit(**values) -> None:
        for name, held_values in columns.items():
            held_values.append(values.get(name))

    below_saved = below_leaves = np.zeros(0, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        saved = level.n_convs * level.size - np.where(level.opens_left, 0, level.size)
        leaves = (~level.opens_right & (level.held == 0)).astype(np.int64)
        if len(below_saved):
            np.add.at(saved, levels[depth + 1].parent, below_saved)
            np.add.at(leaves, levels[depth + 1].parent, below_leaves)
        below_saved, below_leaves = saved, leaves
        names = {path[depth]: key[depth] for path, key in paths if depth < len(key)}
        above = {path[depth - 1]: key[depth - 1] for path, key in paths
                 if 0 < depth <= len(key)}
        for i in range(len(level.first)):
            parent = int(level.parent[i])
            key, ends = names.get(i), level.ends[i]
            common = dict(
                shard=shard, key=key, conv_id=int(level.conv[i]), depth=depth,
                parent_key=above.get(parent), n_convs=int(level.n_convs[i]),
                parent_conv_id=int(levels[depth - 1].conv[parent]) if depth else None,
                n_children=int(level.children[i]), n_leaves=int(leaves[i]),
                saved_tokens=int(saved[i]))
            if key is None:
                text = ",".join(map(str, ends.tolist())).encode()
                emit(**common, ends_sha256=hashlib.sha256(text).hexdigest())
                continue
            emit(**common)
            for begin in range(0, len(ends), CHUNK):
                some = ends[begin:begin + CHUNK].tolist()
                emit(shard=shard, key=key, depth=depth, parent_key=above.get(parent), n_convs=0,
                     n_children=0, n_leaves=0, saved_tokens=0, chunk_from=some[0],
                     chunk=",".join(map(str, some)))
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.table({name: pa.array(columns[name], kinds[kind])
                     for name, kind in (f.split() for f in NODE.split(", "))})


def _recombined(nodes: DataFrame) -> DataFrame:
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    parts = nodes.where("key IS NOT NULL")

    def ends(batches):
        key, whole, empty = None, None, True
        for batch in batches:
            for here, chunk in zip(batch.column("key").to_pylist(), batch.column("chunk").to_pylist()):
                if here != key:
                    if key is not None:
                        yield pa.record_batch({"key": [key], "ends_sha256": [whole.hexdigest()]})
                    key, whole, empty = here, hashlib.sha256(), True
                whole.update((chunk if empty else "," + chunk).encode())
                empty = False
        if key is not None:
            yield pa.record_batch({"key": [key], "ends_sha256": [whole.hexdigest()]})

    digests = (parts.where("chunk IS NOT NULL").select("key", "chunk_from", "chunk")
               .repartition("key").sortWithinPartitions("key", "chunk_from")
               .mapInArrow(ends, "key string, ends_sha256 string"))
    whole = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"), *[F.sum(n).alias(n) for n in numbers]
    ).join(digests, "key", "left").withColumns({
        "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)),
        "parent_conv_id": F.lit(None).cast("long")})
    whole = materialize(whole, "trie-borders")
    columns = ["conv_id", "depth", "parent_key", "parent_conv_id", *numbers, "ends_sha256"]
    every = nodes.where("key IS NULL").select(*columns).unionByName(whole.select(*columns))
    above = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    if above.count() <= BROADCAST_NODES:
        above = F.broadcast(above)
    below = every.where("parent_key IS NOT NULL").join(above, "parent_key").withColumn(
        "parent_conv_id", F.col("_above")).select(*columns)
    settled = every.where("parent_key IS NULL").unionByName(below)
    return settled.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id",
                          *numbers, "ends_sha256")


def conversation_trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED,
                      shards: int | None = None) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie_nodes(rebuilt(conversations, family, shared), shards)
