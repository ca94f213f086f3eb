"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample of vectors (``sample`` rows by hash) on the driver; every vector is then put into a leaf. Vectors
get one more component, ``sqrt(longest^2 - length^2)``, which makes the order by distance the order by inner
product. A query keeps a priority queue of tree nodes by distance, opens the nearest and visits leaves in the order in
which they come out. The number of leaves is widened until, for a bounded sample of queries compared
exactly with all rows, the wanted share of true neighbours lies in the visited leaves; every query goes on until its leaves hold enough
rows. Visited leaves are joined with their vectors in blocks of bounded size on both sides, so neither
a leaf with a third of all rows nor one that all queries visit is one task's work. Scores are sums in component order in double precision, so
equal vectors have equal scores wherever they are computed.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an id;
vectors of another length than the query's are no candidates; repeated rows are rows of their own (an id may be
listed twice, and a repeated query gets a list for each row); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.shared import boundaries, runs, staged
from exactsync.llm.vectors import _matrix, usable

K = 20
RECALL = 0.96
SAMPLE = 16_384
QUERIES_COMPARED = 128
BRANCHES = 8
LEAF_SAMPLE = 96
ROWS_PER_BLOCK = 2048
QUERIES_PER_BLOCK = 256
SEED = 5


class Tree:
    """Centres and children of every inner node; leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, longest: float, branches: int, leaf_sample: int, seed: int):
        self.longest, self.rng = longest, np.random.default_rng(seed)
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []  # an inner node's number, or -1 - leaf
        self.leaves = 0
        self.root = self._split(self.lifted(sample), branches, leaf_sample)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.longest**2 - (rows * rows).sum(axis=1)))
        return np.column_stack([rows, rest])

    def _split(self, rows: np.ndarray, branches: int, leaf_sample: int) -> int:
        if len(rows) > leaf_sample:
            groups, centres = self._means(rows, branches)
            if len(centres) > 1:
                at = len(self.centres)
                self.centres.append(centres)
                self.children.append([])
                for n in range(len(centres)):
                    self.children[at].append(self._split(rows[groups == n], branches, leaf_sample))
                return at
        self.leaves += 1
        return -self.leaves

    def _means(self, rows: np.ndarray, branches: int) -> tuple[np.ndarray, np.ndarray]:
        centres = rows[self.rng.choice(len(rows), min(branches, len(rows)), replace=False)]
        for _ in range(10):
            groups = _squares(rows, centres).argmin(axis=1)
            used = np.unique(groups)
            groups = np.searchsorted(used, groups)
            centres = np.stack([rows[groups == n].mean(axis=0) for n in range(len(used))])
        groups = _squares(rows, centres).argmin(axis=1)
        used = np.unique(groups)
        return np.searchsorted(used, groups), centres[used]

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest child on every level."""
        rows, out = self.lifted(rows), np.zeros(len(rows), np.int64)
        todo = [(self.root, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                out[at] = -1 - node
                continue
            nearest = _squares(rows[at], self.centres[node]).argmin(axis=1)
            todo += [(c, at[nearest == n]) for n, c in enumerate(self.children[node]) if (nearest == n).any()]
        return out

    def visits(self, query: np.ndarray, count: int, held: np.ndarray, enough: int) -> list[int]:
        """Leaves in the order of the priority queue: ``count`` of them, and more until they hold ``enough`` rows."""
        point = np.append(query, 0.0)
        queue, found, rows = [(0.0, self.root)], [], 0
        while queue and (len(found) < count or rows < enough):
            _, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                rows += int(held[-1 - node])
                continue
            away = self.centres[node] - point
            for distance, child in zip((away * away).sum(axis=1).tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (distance, child))
        return found


def _squares(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances up to a term of the row alone."""
    return (centres * centres).sum(axis=1) - 2.0 * rows @ centres.T


_HITS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("query", "query_id", "vec_id", "leaf")]
    + [T.StructField("score", T.DoubleType())]
)


def _hits(queries, rows, k: int) -> pa.RecordBatch:
    """Best ``k`` rows of each query. Both are (numbers, ids, vectors), rows also with leaves; a query's own row is left out."""
    numbers, ids, vectors = queries
    row_numbers, row_ids, row_vectors, leaves = rows
    # A matrix product sums in an order of its own; it only tells which rows can be among the best, with room for its error.
    rough = vectors @ row_vectors.T
    rough[numbers[:, None] == row_numbers[None, :]] = -np.inf
    if rough.shape[1] > k:
        error = 1e-12 * np.sqrt((vectors**2).sum(axis=1) * (row_vectors**2).sum(axis=1).max())
        floor = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k] - error
        of, at = np.nonzero((rough >= floor[:, None]) & (rough > -np.inf))
    else:
        of, at = np.nonzero(rough > -np.inf)
    scores = np.zeros(len(of))
    for part in range(vectors.shape[1]):  # summed in component order
        scores += vectors[of, part] * row_vectors[at, part]
    order = np.lexsort((row_ids[at], -scores, of))
    of, at, scores = of[order], at[order], scores[order]
    first = np.searchsorted(of, np.arange(len(numbers)))
    best = np.arange(len(of)) - first[of] < k
    of, at, scores = of[best], at[best], scores[best]
    columns = (numbers[of], ids[of], row_ids[at], leaves[at], scores)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _HITS.names)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _some(rows: DataFrame, count: int, salt: str) -> list:
    """About ``count`` rows by hash, at most twice as many."""
    total = max(1, rows.count())
    part = F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(1 << 40)) < int(min(1.0, count / total) * (1 << 40))
    return rows.where(part).limit(2 * count).collect()


def _compared(rows: DataFrame, queries: list, k: int) -> DataFrame:
    """Exact best rows of a few queries over all rows."""
    numbers = np.array([q["number"] for q in queries], np.int64)
    ids = np.array([q["vec_id"] for q in queries], np.int64)
    vectors = np.array([q["vector"] for q in queries], np.float64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            if batch.num_rows:
                own = [batch.column(n).to_numpy() for n in ("number", "vec_id")]
                found = _hits((numbers, ids, vectors), (*own, _matrix(batch.column("vector")), batch.column("leaf").to_numpy()), k)
                best = found if best is None else _merged(best, found, k)
        if best is not None:
            yield best

    return _best(rows.mapInArrow(compare, _HITS), k)


def _merged(a: pa.RecordBatch, b: pa.RecordBatch, k: int) -> pa.RecordBatch:
    both = pa.Table.from_batches([a, b]).combine_chunks()
    columns = {n: both.column(n).to_numpy() for n in _HITS.names}
    order = np.lexsort((columns["vec_id"], -columns["score"], columns["query"]))
    query = columns["query"][order]
    first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return both.take(pa.array(order[rank < k])).combine_chunks().to_batches()[0]


def _search(rows: DataFrame, k: int, every: int, recall: float, sample: int, seed: int) -> DataFrame:
    """Neighbours among ``rows`` (``number``, ``vec_id``, ``vector``, all of one length)."""
    longest = float(np.sqrt(rows.agg(F.max("squares")).first()[0]))
    fitted = _some(rows, sample, "tree")
    fitted = np.array([r["vector"] for r in fitted or rows.limit(1).collect()], np.float64)
    tree = Tree(fitted, longest, BRANCHES, LEAF_SAMPLE, seed)
    schema = T.StructType([*rows.schema.fields, T.StructField("leaf", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = pa.array(tree.leaf(_matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, leaves], schema.names)

    placed = staged(rows.mapInArrow(place, schema), "placed")
    held = np.zeros(tree.leaves, np.int64)
    for leaf, count in placed.groupBy("leaf").count().collect():  # at most one row per leaf of the fitted tree
        held[leaf] = count
    asked = placed.where(F.pmod("vec_id", F.lit(every)) == 0)
    chosen = _some(asked, QUERIES_COMPARED, "calibrate")
    visits = _calibrated(tree, held, chosen, _compared(placed, chosen, k).collect() if chosen else [], k, recall)

    fields = {"number": T.LongType(), "vec_id": T.LongType(), "vector": rows.schema["vector"].dataType, "leaf": T.LongType()}
    visited = T.StructType([T.StructField(n, t) for n, t in fields.items()])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tree.visits(q, visits, held, 4 * k + 1) for q in _matrix(batch.column("vector"))] if batch.num_rows else []
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]).astype(np.int64))
            leaves = pa.array([leaf for f in found for leaf in f], pa.int64())
            columns = [batch.column(n).take(at) for n in list(fields)[:3]]
            yield pa.RecordBatch.from_arrays([*columns, leaves], visited.names)

    routes = staged(asked.select(*list(fields)[:3]).mapInArrow(visit, visited), "routes")
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / ROWS_PER_BLOCK).alias("row_blocks"))
    asks = routes.groupBy("leaf").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).alias("query_blocks"))
    blocks = F.broadcast(sizes.join(asks, "leaf"))  # one row per leaf of the fitted tree

    def dealt(side: DataFrame, own: str, other: str, kind: int) -> DataFrame:
        block = F.pmod(F.xxhash64("number", "leaf"), own)
        spread = side.select(*fields).join(blocks, "leaf").select(
            *fields, block.alias(own[:-1]), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[:-1])
        )
        return spread.withColumn("kind", F.lit(kind))

    both = dealt(placed, "row_blocks", "query_blocks", 0).unionByName(dealt(routes, "query_blocks", "row_blocks", 1))
    keys = ["leaf", "row_block", "query_block"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            table = table.combine_chunks()
            ends = boundaries(table, keys)
            kinds = table.column("kind").to_numpy()
            parts = []
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                cut = start + int((kinds[start:end] == 0).sum())
                if start < cut < end:
                    sides = []
                    for a, b in ((cut, end), (start, cut)):
                        part = table.slice(a, b - a)
                        own = [part.column(n).to_numpy() for n in ("number", "vec_id")]
                        sides.append((*own, _matrix(part.column("vector").combine_chunks()), part.column("leaf").to_numpy()))
                    parts.append(_hits(sides[0][:3], sides[1], k))
            if parts:
                yield from pa.Table.from_batches(parts).combine_chunks().to_batches()

    cells = both.repartition(*keys).sortWithinPartitions(*keys, "kind")
    return _best(cells.mapInArrow(compare, _HITS), k)


def _calibrated(tree: Tree, held: np.ndarray, queries: list, truth: list, k: int, recall: float) -> int:
    """Fewest leaves that hold the wanted share of the true neighbours of the compared queries."""
    orders = {}
    for q in queries:
        visits = tree.visits(np.array(q["vector"], np.float64), tree.leaves, held, 0)
        orders[q["number"]] = {leaf: n for n, leaf in enumerate(visits)}
    places = sorted(orders[t["query"]][t["leaf"]] for t in truth)
    if not places:
        return 1
    return places[min(len(places) - 1, int(np.ceil(recall * len(places))))] + 1


def nearest(
    vectors: DataFrame,
    k: int = K,
    every: int = 20,
    recall: float = RECALL,
    sample: int = SAMPLE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    seed: int = SEED,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found; queries are the rows whose id is divisible by ``every``."""
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector")).withColumn("number", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("squares", squares), "vectors")
    out = None
    for (dim,) in rows.select(F.size("vector")).distinct().collect():  # lengths of vectors, as a rule one
        found = _search(rows.where(F.size("vector") == dim), k, every, recall, sample, seed)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = _best(rows.select(*(F.lit(0).cast(f.dataType).alias(f.name) for f in _HITS.fields)), k)
    return out.select("query_id", "rank", "vec_id", "score")
