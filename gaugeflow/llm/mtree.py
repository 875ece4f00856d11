"""Exact top-k inner products by best-first search of an M-tree.

Vectors are taken as floor(scale * x) per component. The tree has two paged
levels: cells around routing vectors from a bounded sample, and pages of at most
PAGE_ROWS vectors below them. A node keeps its centre, its covering radius and the
distance of its centre to its parent's; a page keeps each vector's distance to its
centre. With the triangle inequality, no vector x below a centre c can score more
against q than q.c + |q| d(x, c), so stored distances rule out nodes and vectors
without computing anything about them: first a page from its cell's centre alone,
then a page from its own centre, then the vectors of a page from their stored
distances. Nodes are visited best bound first, against the k-th best score so far;
the first one comes from the query's own neighbourhood while the tree is built.

Scores are integers and exact: floating point is used only where it represents
them exactly, Python integers otherwise (saturated to 64 bits), and bounds are
widened before they rule anything out. Null vectors, vectors with null or
non-finite components and rows with a null id take no part; shorter vectors count
as filled with zeros; equal rows count once, and a query never meets its own id.
Other columns are ignored.

At scale: every stated query must face every vector that bounds cannot exclude, so
queries go through the pages in blocks of a fixed size, which makes the broadcast
bounded. Cells are salted by their size, so a crowd of equal vectors is many pages
in many tasks. A task returns at most k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.groups import sorted_groups
from gaugeflow.session import materialize

#: Vectors in a page, vectors clustered at once, cells, and queries sent out at once.
PAGE_ROWS, CHUNK_ROWS, CELLS, QUERY_BLOCK = 512, 8192, 256, 32_768
EXACT = 2.0 ** 53
#: Relative slack of bounds against rounding.
SLACK = 1e-9

PAGES = ("cell long, page_radius double, to_cell double, center binary, ids binary, "
         "vectors binary, distances binary")


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): the integer vectors that take part, each row once."""
    whole = F.col("embedding").cast("array<double>")
    # a product that is too large for 64 bits saturates
    integer = lambda x: F.floor(F.lit(float(scale)) * x).cast("long")
    fine = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(whole, integer).alias("v")).distinct())


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Integer vectors as rows, filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Euclidean distances, rounded up a little."""
    x, centers = x.astype(np.float64), centers.astype(np.float64)
    squares = (x * x).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2 * x @ centers.T
    slack = SLACK * ((x * x).sum(1)[:, None] + (centers * centers).sum(1)[None, :] + 1)
    return np.sqrt(np.maximum(squares, 0) + slack)


def inner(queries: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    top = float(np.abs(queries.astype(np.float64)).max(initial=0))
    top *= float(np.abs(x.astype(np.float64)).max(initial=0)) * max(queries.shape[1], 1)
    if top < EXACT:
        return np.rint(queries.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    products = queries.astype(object) @ x.astype(object).T
    return np.clip(products, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row the k-th largest score, or the smallest number where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), np.iinfo(np.int64).min)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def build_pages(rows: DataFrame, dims: int, cells: np.ndarray, salts: np.ndarray, k: int,
                every: int, page_rows: int) -> DataFrame:
    """Leaf pages, and one row (ids of one, no radius) per query with its first k-th best score."""
    held = rows.sparkSession.sparkContext.broadcast((cells, salts))

    def assign(batches):
        cells, salts = held.value
        for batch in batches:
            v = matrix(batch.column(1), dims)
            d = distances(v, cells)
            cell = d.argmin(axis=1)
            ids = batch.column(0).to_numpy()
            salt = (ids * 0x9E3779B1 >> 7) % salts[cell]
            yield pa.record_batch(
                [pa.array(cell.astype(np.int64)), pa.array(salt), batch.column(0),
                 pa.array([r.tobytes() for r in v], pa.binary())], names=["cell", "salt", "vec_id", "v"])

    def cluster(batches):
        cells, _ = held.value
        for group in sorted_groups(batches, 2):
            for at in range(0, group.num_rows, CHUNK_ROWS):
                part = group.slice(at, CHUNK_ROWS)
                cell = part.column(0)[0].as_py()
                ids = part.column(2).to_numpy()
                v = np.stack([np.frombuffer(x.as_buffer(), np.int64) for x in part.column(3)])
                yield _pages(cell, cells[cell], ids, v, page_rows)
                asked = np.flatnonzero(ids % every == 0)
                if len(asked):
                    yield _queries(cell, ids, v, asked, k)

    return (rows.mapInArrow(assign, "cell long, salt long, vec_id long, v binary")
            .repartition("cell", "salt").sortWithinPartitions("cell", "salt", "vec_id")
            .mapInArrow(cluster, PAGES))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.float64(), pa.float64()] + [pa.binary()] * 4
    names = ["cell", "page_radius", "to_cell", "center", "ids", "vectors", "distances"]
    return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                           names=names)


def _pages(cell: int, cell_center: np.ndarray, ids: np.ndarray, v: np.ndarray,
           page_rows: int) -> pa.RecordBatch:
    """Split vectors around far-apart ones until every part fits a page."""
    todo, rows = [np.arange(len(ids))], []
    while todo:
        part = todo.pop()
        x = v[part]
        if len(part) > page_rows:
            a = int(distances(x, x[:1])[:, 0].argmax())
            b = int(distances(x, x[a:a + 1])[:, 0].argmax())
            d = distances(x, x[[a, b]])
            order = np.argsort(d[:, 0] - d[:, 1], kind="stable")
            todo += [part[order[:len(part) // 2]], part[order[len(part) // 2:]]]
            continue
        center = np.rint(x.astype(np.float64).mean(axis=0)).astype(np.int64)
        d = distances(x, center[None, :])[:, 0]
        order = np.argsort(-d, kind="stable")
        to_cell = float(distances(center[None, :], cell_center[None, :])[0, 0])
        rows.append((cell, float(d.max()), to_cell, center.tobytes(), ids[part[order]].tobytes(),
                     x[order].tobytes(), d[order].tobytes()))
    return _batch(rows)


def _queries(cell: int, ids: np.ndarray, v: np.ndarray, asked: np.ndarray, k: int) -> pa.RecordBatch:
    scores = inner(v[asked], v)
    scores[ids[asked][:, None] == ids[None, :]] = np.iinfo(np.int64).min
    best = kth_best(scores, k)
    return _batch([(cell, None, None, best[i:i + 1].tobytes(), ids[a:a + 1].tobytes(),
                    v[a].tobytes(), b"") for i, a in enumerate(asked.tolist())])


class Search:
    """Best scores of a block of queries over the pages that a task is given."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, cells: np.ndarray,
                 k: int) -> None:
        self.ids, self.queries, self.floor, self.k = ids, queries, floor.copy(), k
        self.norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * (1 + SLACK) + SLACK
        self.cell_scores = queries.astype(np.float64) @ cells.astype(np.float64).T
        self.found: list[np.ndarray] = []
        self.held = 0

    def _may_reach(self, bound: np.ndarray, who: np.ndarray) -> np.ndarray:
        return bound + SLACK * (np.abs(bound) + 1) >= self.floor[who]

    def visit(self, pages: list[tuple]) -> None:
        """Visit pages (cell, radius, to_cell, center, ids, vectors, distances), best first."""
        everyone = np.arange(len(self.ids))
        if not len(everyone):
            return
        bounds = [float((self.cell_scores[:, p[0]] + self.norms * (p[1] + p[2])).max()) for p in pages]
        for i in np.argsort(-np.array(bounds), kind="stable").tolist():
            cell, radius, to_cell, center, ids, v, d = pages[i]
            far = self.cell_scores[:, cell] + self.norms * (to_cell + radius)
            who = everyone[self._may_reach(far, everyone)]
            if not len(who):
                continue
            middle = self.queries[who].astype(np.float64) @ center.astype(np.float64)
            near = self._may_reach(middle + self.norms[who] * radius, who)
            who, middle = who[near], middle[near]
            if not len(who):
                continue
            # vectors are ordered by falling distance to the centre; their bounds fall with them
            need = float(((self.floor[who] - middle) / np.maximum(self.norms[who], SLACK)).min())
            use = int((d + SLACK * (d + 1) + 1e-6 * abs(need) >= need).sum())
            if not use:
                continue
            scores = inner(self.queries[who], v[:use])
            good = scores >= self.floor[who][:, None]
            good &= self.ids[who][:, None] != ids[None, :use]
            q, x = np.nonzero(good)
            self.found.append(np.stack([who[q], ids[x], scores[q, x]], axis=1))
            self.held += len(q)
            if self.held > 4 * self.k * max(len(self.ids), 64):
                self._shrink()

    def _shrink(self) -> None:
        """Keep the k best per query and raise the floors."""
        rows = self.best()
        self.found, self.held = [rows], len(rows)
        count = np.bincount(rows[:, 0], minlength=len(self.ids))
        ends = np.cumsum(count)
        full = np.flatnonzero(count >= self.k)
        self.floor[full] = np.maximum(self.floor[full], rows[ends[full] - 1, 2])

    def best(self) -> np.ndarray:
        rows = np.concatenate(self.found) if self.found else np.zeros((0, 3), np.int64)
        rows = rows[np.lexsort((rows[:, 1], -rows[:, 2].astype(np.float64), rows[:, 0]))]
        if np.abs(rows[:, 2].astype(np.float64)).max(initial=0) >= EXACT:
            order = sorted(range(len(rows)), key=lambda i: (int(rows[i, 0]), -int(rows[i, 2]), int(rows[i, 1])))
            rows = rows[order]
        starts = np.searchsorted(rows[:, 0], rows[:, 0])
        return rows[np.arange(len(rows)) - starts < self.k]


def search(pages: DataFrame, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray,
           cells: np.ndarray, k: int) -> DataFrame:
    """Candidates (query, vec_id, score) of one block of queries, at most k per query and task."""
    held = pages.sparkSession.sparkContext.broadcast((ids, queries, floor, cells))

    def run(batches):
        ids, queries, floor, cells = held.value
        task = Search(ids, queries, floor, cells, k)
        for batch in batches:
            nodes = []
            for row in batch.to_pylist():
                mine = np.frombuffer(row["ids"], np.int64)
                nodes.append((row["cell"], row["page_radius"], row["to_cell"],
                              np.frombuffer(row["center"], np.int64), mine,
                              np.frombuffer(row["vectors"], np.int64).reshape(len(mine), -1),
                              np.frombuffer(row["distances"], np.float64)))
            task.visit(nodes)
        rows = task.best()
        yield pa.record_batch([pa.array(ids[rows[:, 0]]), pa.array(rows[:, 1].copy()),
                               pa.array(rows[:, 2].copy())], names=["query", "vec_id", "score"])

    return pages.mapInArrow(run, "query long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 20, scale: int = 64, every: int = 20,
          page_rows: int = PAGE_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query, rank, vec_id, score): the k best other rows of each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors, scale), "mtree-vectors")
    dims, count = rows.agg(F.max(F.size("v")), F.count("*")).first()
    dims = dims or 0
    sample = (rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CELLS)
              .select("v").toArrow()["v"].combine_chunks())
    cells = matrix(sample, dims) if len(sample) else np.zeros((1, dims), np.int64)
    cells = cells[:max(1, min(CELLS, count // (4 * page_rows)))]
    salts = _salts(rows, dims, cells)
    built = materialize(build_pages(rows, dims, cells, salts, k, every, page_rows), "mtree-pages")
    pages = built.where("page_radius IS NOT NULL")
    asked = built.where("page_radius IS NULL").select("center", "ids", "vectors")
    blocks = max(1, -(-asked.count() // query_block))
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("ids"), F.lit(blocks)) == block).toArrow()
        pick = lambda name: np.frombuffer(b"".join(mine[name].to_pylist()), np.int64)
        part = search(pages, pick("ids"), pick("vectors").reshape(len(mine), dims), pick("center"),
                      cells, k)
        part = materialize(part, "mtree-found") if blocks > 1 else part
        found = part if found is None else found.union(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", "vec_id", "score"))


def _salts(rows: DataFrame, dims: int, cells: np.ndarray) -> np.ndarray:
    """How many groups each cell's vectors are dealt to."""
    held = rows.sparkSession.sparkContext.broadcast(cells)

    def nearest(batches):
        for batch in batches:
            cell = distances(matrix(batch.column(0), dims), held.value).argmin(axis=1)
            yield pa.record_batch([pa.array(cell.astype(np.int64))], names=["cell"])

    counts = (rows.select("v").mapInArrow(nearest, "cell long").groupBy("cell").count().collect())
    out = np.ones(len(cells), np.int64)
    for row in counts:
        out[row.cell] = max(1, -(-row["count"] // (CHUNK_ROWS // 2)))
    return out
