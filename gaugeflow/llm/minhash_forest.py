"""N-gram Jaccard join by MinHash with banding of a fixed depth and exact verification.

Documents are sets of word 5-grams (a document of fewer words is one n-gram of
all its words). Documents with equal sets form one class and are joined once.
Every class has one signature per tree. The depth of an LSH forest at which classes at
the threshold meet in some tree with the target recall follows from constants, so it
is computed before running, and each tree is one band: a hash of the signature's prefix
of that depth. No signatures are sorted and no prefix shortens while running. Classes
with an equal band are a node; in it, signatures are compared whole by a sketch, and
classes that may be similar are linked, and the connected groups of those links, not pairs, go on to
verification: the sets of each group meet once, in blocks, and every pair of the
group is compared exactly.

Result, one row per document row: class_id (smallest doc_id of the connected
group of documents linked by similarity >= threshold), copy_id (smallest doc_id
with the same set), n_copies (rows with the same set), n_links (other sets that
are similar), kept (true for one row of each class, the smallest doc_id).
Null and empty texts have no set: each is a class of its own and kept. Null
doc_ids come last in every order; repeated rows are copies. Other columns are
ignored.

At scale: the forest shuffles prefixes that at least two classes share, with an
80-byte sketch; sets move only for classes in a group. Large trie nodes and large
groups are split into pairs of blocks, so no task holds more than two blocks.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import text as T
from gaugeflow.llm.components import connected_components
from gaugeflow.llm.groups import components, sorted_groups
from gaugeflow.llm.keyfilter import KeyFilter, build_filter
from gaugeflow.llm.names import free_name
from gaugeflow.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 5
RECALL = 0.999
#: Classes of a trie node, and classes and n-grams of a group, in one block.
NODE_BLOCK = 4096
GROUP_BLOCK = 1024
GROUP_GRAMS = 400_000
#: Keys (of some 100 bytes) that are broadcast.
BROADCAST_KEYS = 200_000


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH,
                 target: float = RECALL) -> int:
    """The longest prefix whose forest finds a pair at the threshold with the target recall."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def gram_sets(found: T.Words, size: int) -> tuple[list[np.ndarray], list[int]]:
    """The sorted distinct n-gram hashes of each row that has words, and those rows."""
    hashes = T.ngrams(found.hashes, size)
    sets, rows = [], []
    bounds = found.offsets.tolist()
    for r, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        if hi - lo >= size:
            mine = hashes[lo:hi - size + 1]
        elif hi > lo:
            mine = T.ngrams(found.hashes[lo:hi], hi - lo)
        else:
            continue
        mine = np.sort(mine)
        keep = np.ones(len(mine), dtype=bool)
        keep[1:] = mine[1:] != mine[:-1]
        sets.append(mine[keep])
        rows.append(r)
    return sets, rows


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that identify each set."""
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    joined = np.concatenate(sets)
    return (np.add.reduceat(T.mix(joined), starts),
            np.add.reduceat(T.mix(joined ^ T.constants(1, 7)[0]), starts))


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash signatures: 32-bit minima under `count` permutations, one row per set."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    factors = (T.constants(count, 2) >> np.uint64(16)).astype(np.uint32) | np.uint32(1)
    turns = (T.constants(count, 3) >> np.uint64(16)).astype(np.uint32)
    out = np.empty((len(sets), count), np.uint32)
    for i in range(count):
        out[:, i] = np.minimum.reduceat((values ^ turns[i]) * factors[i], starts)
    return out


def prefixes(signature: np.ndarray, trees: int, depth: int, used: int) -> np.ndarray:
    """One 64-bit key per tree for the first `used` of its `depth` values."""
    shaped = signature.reshape(len(signature), trees, depth)[:, :, :used].astype(np.uint64)
    factors = T.constants(used, 4)
    return T.mix((shaped * factors).sum(axis=2, dtype=np.uint64)
                 + T.constants(trees, 5)[None, :])


def sign(documents: DataFrame, threshold: float, trees: int, depth: int, target: float,
         size: int) -> DataFrame:
    """Per document row: the set's fingerprint and size, the forest's prefixes and a sketch."""
    used = prefix_depth(threshold, trees, depth, target)

    def run(batches):
        for batch in batches:
            for block in T.blocks(batch.column(3)):
                found = T.words(block)
                sets, rows = gram_sets(found, size)
                n = block.rows
                grams = np.zeros(n, np.int64)
                fp = np.zeros((2, n), np.uint64)
                keys: list = [None] * n
                sketch: list = [None] * n
                if sets:
                    grams[rows] = [len(s) for s in sets]
                    fp[0, rows], fp[1, rows] = fingerprints(sets)
                    signature = signatures(sets, trees * depth)
                    at = prefixes(signature, trees, depth, used).view(np.int64)
                    low = signature.astype(np.uint8)
                    for i, r in enumerate(rows):
                        keys[r], sketch[r] = at[i], low[i].tobytes()
                part = batch.slice(block.first, n)
                yield pa.record_batch(
                    [part.column(0), part.column(1), part.column(2),
                     pa.array(fp[0].view(np.int64)), pa.array(fp[1].view(np.int64)),
                     pa.array(grams), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(sketch, pa.binary())],
                    names=["row", "doc_id", "text_key", "fp1", "fp2", "grams", "keys", "sketch"])

    text = F.col("text").cast("string")
    return (documents.select(F.monotonically_increasing_id().alias("row"),
                             F.col("doc_id").cast("long"),
                             F.md5(text.cast("binary")).alias("text_key"), text.alias("text"))
            .mapInArrow(run, "row long, doc_id long, text_key string, fp1 long, fp2 long, "
                             "grams long, keys array<long>, sketch binary"))


def sketch_groups(sketches: np.ndarray, least: float) -> np.ndarray:
    """Each row's first row in the connected group of rows that agree in enough places."""
    labels = np.full(len(sketches), -1)
    rest = np.arange(len(sketches))
    need = least * sketches.shape[1]
    while len(rest):
        seed, rest = rest[0], rest[1:]
        labels[seed] = seed
        frontier = np.array([seed])
        while len(frontier) and len(rest):
            some, frontier = frontier[:16], frontier[16:]
            near = np.zeros(len(rest), dtype=bool)
            for one in some:
                near |= (sketches[rest] == sketches[one]).sum(axis=1) >= need
            labels[rest[near]] = seed
            frontier = np.concatenate([frontier, rest[near]])
            rest = rest[~near]
    return labels


def _block_pairs(df: DataFrame, blocks: str, by: str) -> DataFrame:
    """Deal rows to pairs of blocks: all rows of two blocks meet in the task of (bi, bj)."""
    mine = F.pmod(F.xxhash64(by), F.col(blocks))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    return (df.withColumn("mine", mine.cast("long")).withColumn("other", other)
            .withColumn("bi", F.least("mine", "other")).withColumn("bj", F.greatest("mine", "other"))
            .drop("other", blocks))


def forest_links(classes: DataFrame, threshold: float, places: int, node_block: int) -> DataFrame:
    """Links (a, b) between classes that share a prefix and whose sketches nearly agree.

    The sketch must agree in a share of its places of four standard deviations
    below the threshold, so it drops about one of 30,000 pairs at the threshold.
    """
    least = threshold - 4 * (threshold * (1 - threshold) / places) ** 0.5
    shared = materialize(classes.select(F.explode("keys").alias("key")).groupBy("key")
                         .agg(F.count("*").alias("n")).where("n > 1"), "forest-nodes")
    held = classes.sparkSession.sparkContext.broadcast(build_filter(shared, "key").bits)

    def spread(batches):
        keys = KeyFilter(held.value)
        for batch in batches:
            at = batch.column(1)
            flat = np.ascontiguousarray(at.flatten().to_numpy(zero_copy_only=False), np.int64)
            owner = np.repeat(np.arange(batch.num_rows), at.value_lengths().to_numpy())
            good = keys.passes(flat)
            take = pa.array(owner[good])
            yield pa.record_batch([pa.array(flat[good]), batch.column(0).take(take),
                                   batch.column(2).take(take)], names=["key", "node", "sketch"])

    def compare(batches):
        for group in sorted_groups(batches, 3):
            if group.num_rows < 2:
                continue
            data, _ = T.utf8(group.column(4))
            begin = group.column(4).offset
            flat = np.frombuffer(group.column(4).buffers()[2], np.uint8)
            offset = np.frombuffer(group.column(4).buffers()[1], np.int32)[begin]
            m = group.num_rows
            sketches = flat[offset:offset + m * places].reshape(m, places)
            first = sketch_groups(sketches, least)
            moved = np.flatnonzero(first != np.arange(m))
            if len(moved):
                nodes = group.column(3).to_numpy()
                yield pa.record_batch([pa.array(nodes[moved]), pa.array(nodes[first[moved]])],
                                      names=["a", "b"])

    rows = classes.select("node", "keys", "sketch").mapInArrow(
        spread, "key long, node long, sketch binary")
    large = shared.where(F.col("n") > node_block).select(
        "key", F.ceil(F.col("n") / node_block).alias("blocks"))
    dealt = _block_pairs(rows.join(large, "key", "left")
                         .withColumn("blocks", F.coalesce("blocks", F.lit(1))), "blocks", "node")
    return (dealt.select("key", "bi", "bj", "node", "sketch")
            .repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "node")
            .mapInArrow(compare, "a long, b long").distinct())


def similar(sets: list[np.ndarray], left: np.ndarray, ratio: Fraction) -> np.ndarray:
    """Which sets are similar: a symmetric matrix; with two sides, only across them.

    left marks the sets of the first block of two; all true compares all.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    column = np.cumsum(often) - 1
    used = often[place]
    owner, place = owner[used], column[place[used]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    whole = bool(left.all())
    a = np.arange(m) if whole else np.flatnonzero(left)
    b = np.arange(m) if whole else np.flatnonzero(~left)
    common = np.zeros((len(a), len(b)), np.float32)
    width = 2048
    total = int(often.sum())
    for at in range(0, total, width):
        lo, hi = np.searchsorted(place, [at, at + width])
        grid = np.zeros((m, min(width, total - at)), np.float32)
        grid[owner[lo:hi], place[lo:hi] - at] = 1
        common += grid[a] @ grid[b].T
    common = common.astype(np.int64)
    union = sizes[a][:, None] + sizes[b][None, :] - common
    out = np.zeros((m, m), dtype=bool)
    out[np.ix_(a, b)] = common * ratio.denominator >= ratio.numerator * union
    out |= out.T
    np.fill_diagonal(out, False)
    return out


def verified_links(groups: DataFrame, classes: DataFrame, documents: DataFrame, threshold: float,
                   size: int, group_block: int, group_grams: int) -> DataFrame:
    """(node, root, links): similar classes of each group, counted and tied to a root."""
    members = materialize(
        groups.join(classes.select("node", "fp1", "fp2", "grams"), "node"), "forest-members")
    sizes = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / group_block), F.ceil(F.sum("grams") / group_grams))
        .alias("blocks"))
    held = documents.sparkSession.sparkContext.broadcast(build_filter(members, "fp1").bits)
    ratio = Fraction(threshold).limit_denominator(1000)

    def collect(batches):
        wanted = KeyFilter(held.value)
        for batch in batches:
            for block in T.blocks(batch.column(0)):
                sets, _ = gram_sets(T.words(block), size)
                fp1, fp2 = fingerprints(sets)
                good = np.flatnonzero(wanted.passes(fp1))
                _, first = np.unique(fp1[good], return_index=True)
                good = good[np.sort(first)]
                yield pa.record_batch(
                    [pa.array(fp1[good].view(np.int64)), pa.array(fp2[good].view(np.int64)),
                     pa.array([sets[i].tobytes() for i in good.tolist()], pa.binary())],
                    names=["fp1", "fp2", "set"])

    def verify(batches):
        for group in sorted_groups(batches, 3):
            bi, bj = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            if group.num_rows < 2:
                continue
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column(5)]
            left = group.column(4).to_numpy() == bi if bi != bj else np.ones(len(sets), dtype=bool)
            if left.all() and bi != bj or not left.any():
                continue
            linked = similar(sets, left, ratio)
            links = linked.sum(axis=1)
            rows = np.flatnonzero(links)
            if len(rows):
                nodes = group.column(3).to_numpy()
                root = components(linked[np.ix_(rows, rows)])
                yield pa.record_batch(
                    [pa.array(nodes[rows]), pa.array(nodes[rows[root]]), pa.array(links[rows])],
                    names=["node", "root", "links"])

    sets = (documents.select(F.col("text").cast("string"))
            .mapInArrow(collect, "fp1 long, fp2 long, set binary")
            .groupBy("fp1", "fp2").agg(F.first("set").alias("set")))
    dealt = _block_pairs(members.join(sizes, "component").join(sets, ["fp1", "fp2"]),
                         "blocks", "node")
    return (dealt.select("component", "bi", "bj", "node", "mine", "set")
            .repartition("component", "bi", "bj")
            .sortWithinPartitions("component", "bi", "bj", "node")
            .mapInArrow(verify, "node long, root long, links long"))


def jaccard_join(documents: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE,
                 trees: int = TREES, depth: int = DEPTH, target: float = RECALL,
                 node_block: int = NODE_BLOCK, group_block: int = GROUP_BLOCK,
                 group_grams: int = GROUP_GRAMS) -> DataFrame:
    """One row per document row with its class and number of links; see the module."""
    signed = materialize(sign(documents, threshold, trees, depth, target, size), "forest-signed")
    filled = signed.where("grams > 0")
    classes = materialize(
        filled.groupBy("fp1", "fp2").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("copy_id"),
            F.count("*").alias("n_copies"), F.first("grams").alias("grams"),
            F.first("keys").alias("keys"), F.first("sketch").alias("sketch"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
            .alias("first_row")), "forest-classes")
    links = forest_links(classes, threshold, trees * depth, node_block)
    verified = materialize(
        verified_links(connected_components(links), classes, documents, threshold, size,
                       group_block, group_grams), "forest-verified")
    joined = connected_components(
        verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    placed = (classes.select("node", "fp1", "fp2", "copy_id", "n_copies", "first_row")
              .join(joined, "node", "left").join(counts, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    least = placed.groupBy("component").agg(
        F.min("copy_id").alias("class_id"), F.min("first_row").alias("kept_row"))
    placed = placed.join(least, "component")
    return (signed.select("row", "doc_id", "text_key", "fp1", "fp2", "grams")
            .join(placed.drop("first_row", "node").withColumn("has_set", F.lit(True)),
                  ["fp1", "fp2"], "left")
            .select(
                "doc_id",
                F.when(F.col("grams") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
                .alias("class_id"),
                F.when(F.col("grams") > 0, F.col("copy_id")).otherwise(F.col("doc_id"))
                .alias("copy_id"),
                F.when(F.col("grams") > 0, F.col("n_copies")).otherwise(1).alias("n_copies"),
                F.when(F.col("grams") > 0, F.coalesce("n_links", F.lit(0))).otherwise(0)
                .alias("n_links"),
                F.when(F.col("grams") > 0, F.col("row") == F.col("kept_row.row"))
                .otherwise(True).alias("kept"),
                "text_key"))


def one_per_class(documents: DataFrame, **settings) -> DataFrame:
    """The document rows, with all their columns, that are kept: one of each class.

    Rows without words, null and empty texts among them, all stay, whatever their ids. Of
    rows with equal id and text at most one stays, as they are one class. Up to
    ``BROADCAST_KEYS`` keys of dropped rows are broadcast, so that no text is moved; beyond
    that, rows that a filter of bounded size suspects meet those keys by a shuffle.
    """
    ident, key, pair, gone_id, gone_key, stays = (free_name(n, documents.columns) for n in (
        "doc_key", "text_key", "pair_key", "gone_id", "gone_key", "one_stays"))
    marked = jaccard_join(documents, **settings).select(
        F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key), "kept")
    # rows of one id and text, of which some go; one may be the row that stays
    dropped = materialize(marked.groupBy(gone_id, gone_key).agg(
        F.bool_or("kept").alias(stays), F.bool_and("kept").alias("all_stay"))
        .where("NOT all_stay").drop("all_stay"), "forest-dropped")
    keyed = documents.withColumns({
        ident: F.col("doc_id").cast("long"),
        key: F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit(""))})
    same = F.col(ident).eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    if dropped.count() <= BROADCAST_KEYS:
        suspects, clear = keyed.join(F.broadcast(dropped), same, "left"), None
    else:
        clear, suspects = _by_suspicion(keyed, dropped, pair, [ident, key], [gone_id, gone_key])
        suspects = suspects.join(dropped, same, "left")
    settled = suspects.where(F.col(stays).isNull()).select(*columns).unionByName(
        suspects.where(stays).dropDuplicates([ident, key]).select(*columns))
    return settled if clear is None else settled.unionByName(clear.select(*columns))


def _by_suspicion(rows: DataFrame, listed: DataFrame, pair: str, of_rows: list[str],
                  of_listed: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose keys are surely not listed, and the others."""
    keys = listed.select(F.xxhash64(*of_listed).alias("pair"))
    held = rows.sparkSession.sparkContext.broadcast(build_filter(keys, "pair").bits)
    keyed = rows.withColumn(pair, F.xxhash64(*of_rows))

    def passing(wanted: bool):
        def run(batches):
            suspects = KeyFilter(held.value)
            for batch in batches:
                hit = suspects.passes(np.ascontiguousarray(batch.column(pair).to_numpy(), np.int64))
                yield batch.filter(pa.array(hit == wanted))
        return keyed.mapInArrow(run, keyed.schema)

    return passing(False), passing(True)
