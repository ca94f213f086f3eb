"""Near-duplicate vectors: sign hashes of random hyperplanes, exact cosines, connected components.

Equal vectors become one node with a multiplicity. A table is a set of random hyperplanes through the origin; the signs of a node's
products with them are its bucket there. ``tables`` follows from the number of planes, so that a pair exactly at the
threshold meets in some table with probability ``recall`` (closer pairs more often). Nodes that share a bucket are compared inside
tasks in double precision; a pair counts in the first table where it meets, so tasks return the number of links
per node and a spanning forest, never pairs. A bucket of more than ``cell`` nodes is compared in blocks: every pair of blocks
is a task's work of its own.

Defined cases: null vectors, empty or zero ones and those with null or non-finite components link with nothing, as do vectors of different
lengths; repeated rows and rows with a null id are vectors of their own (a class without any id has a null ``component_id``);
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.components import components
from exactsync.llm.shared import boundaries, runs, staged

THRESHOLD = 0.95
RECALL = 0.9995
CELL = 1024
SEED = 11


def planes_and_tables(nodes: int, threshold: float, recall: float) -> tuple[int, int]:
    """Planes per table, so that far nodes rarely meet, and tables, so that linked ones almost surely do."""
    planes = max(8, math.ceil(math.log2(max(2, nodes))) + 2)
    agree = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def usable(column: str):
    """Whether a vector takes part: components neither null nor infinite nor NaN, and not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """List column with lists of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _units(column: pa.Array) -> np.ndarray:
    rows = _matrix(column)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def signatures(nodes: DataFrame, planes: int, tables: int, seed: int) -> DataFrame:
    """Nodes (``node``, ``vector``, ``times``) with ``signs``: the bucket number of every table, 8 bytes each."""
    schema = T.StructType([*nodes.schema.fields, T.StructField("signs", T.BinaryType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(planes, dtype=np.int64)
        for batch in batches:
            vectors = batch.column("vector")
            lengths = np.asarray(vectors.value_lengths())
            signs: list[bytes] = [b""] * len(vectors)
            for length in np.unique(lengths):
                if int(length) not in normals:
                    rng = np.random.default_rng([seed, int(length)])
                    normals[int(length)] = rng.standard_normal((int(length), planes * tables))
                at = np.flatnonzero(lengths == length)
                above = (_units(vectors.take(pa.array(at))) @ normals[int(length)]) >= 0
                keys = above.reshape(len(at), tables, planes).astype(np.int64) @ powers
                for row, key in zip(at, keys, strict=True):
                    signs[row] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.binary())], schema.names)

    return nodes.mapInArrow(hashed, schema)


def _deal(hashed: DataFrame) -> DataFrame:
    """``node``, ``dim``, ``table``, ``key`` and ``first`` (the key in the first table) for every table."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("node", "dim", "table", "key", "first")])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column("signs").to_pylist()), np.int64).reshape(batch.num_rows, -1)
            for table in range(keys.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node"),
                        batch.column("dim"),
                        pa.array(np.full(batch.num_rows, table)),
                        pa.array(np.ascontiguousarray(keys[:, table])),
                        pa.array(np.ascontiguousarray(keys[:, 0])),
                    ],
                    schema.names,
                )

    return hashed.select("node", F.size("vector").cast("long").alias("dim"), "signs").mapInArrow(deal, schema)


def _near(units: np.ndarray, signs: np.ndarray, table: int, left: slice, right: slice, threshold: float) -> np.ndarray:
    """Which pairs of two stretches are linked and have not met in an earlier table."""
    linked = units[left] @ units[right].T >= threshold
    rows, columns = np.nonzero(linked)
    if table and len(rows):
        met = np.zeros(len(rows), bool)
        a, b = signs[left], signs[right]
        for at in range(0, len(rows), 1 << 16):
            part = slice(at, at + (1 << 16))
            met[part] = (a[rows[part], :table] == b[columns[part], :table]).any(axis=1)
        linked[rows[met], columns[met]] = False
    return linked


def _forest(linked: np.ndarray, names: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the rows of a symmetric matrix as all its links do."""
    todo = linked.any(axis=1)
    out = []
    while todo.any():
        queue = [int(np.argmax(todo))]
        todo[queue[0]] = False
        while queue:
            here = queue.pop()
            found = np.flatnonzero(linked[here] & todo)
            todo[found] = False
            out += [(int(names[here]), int(names[f])) for f in found]
            queue += found.tolist()
    return out


def _compare(cells: DataFrame, threshold: float) -> DataFrame:
    """Rows of ``a`` and ``count`` (links of a node found in a cell) and rows of ``a`` and ``b`` (links that connect)."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "count")])
    keys = ["table", "key", "dim", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            table = table.combine_chunks()
            ends = boundaries(table, keys)
            a: list[int] = []
            b: list[int | None] = []
            count: list[int | None] = []
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                part = table.slice(start, end - start)
                # Blocks stand in order: first that of the lower number, then the other.
                part = part.take(pc.sort_indices(part, [("block", "ascending"), ("node", "ascending")]))
                nodes, times = (part.column(n).to_numpy() for n in ("node", "times"))
                blocks = part.column("block").to_numpy()
                units = _units(part.column("vector").combine_chunks())
                signs = np.frombuffer(b"".join(part.column("signs").to_pylist()), np.int64).reshape(len(nodes), -1)
                which, low, high = (part.column(n)[0].as_py() for n in ("table", "low", "high"))
                cut = int((blocks == low).sum())
                if low == high:
                    linked = _near(units, signs, which, slice(None), slice(None), threshold)
                    np.fill_diagonal(linked, False)
                else:
                    linked = np.zeros((len(nodes), len(nodes)), bool)
                    linked[:cut, cut:] = _near(units, signs, which, slice(0, cut), slice(cut, None), threshold)
                    linked |= linked.T
                links = linked @ times
                at = np.flatnonzero(links)
                a += nodes[at].tolist()
                b += [None] * len(at)
                count += links[at].tolist()
                forest = _forest(linked, nodes)
                a += [x for x, _ in forest]
                b += [y for _, y in forest]
                count += [None] * len(forest)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, count)], schema.names)

    rows = cells.select(*keys, "block", "node", "times", "vector", "signs")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, schema)


def linked_nodes(nodes: DataFrame, threshold: float, recall: float, cell: int, seed: int) -> DataFrame:
    """See :func:`_compare`; ``nodes`` has ``node``, ``vector`` and ``times``, no vector twice."""
    planes, tables = planes_and_tables(nodes.count(), threshold, recall)
    hashed = staged(signatures(nodes, planes, tables, seed), "signed")
    dealt = _deal(hashed)
    bucket = ["table", "key", "dim"]
    sizes = dealt.groupBy(*bucket).agg(
        F.count("*").alias("members"), F.min("first").alias("least"), F.max("first").alias("most")
    )
    # If all members shared the first table's bucket as well, all their pairs have been counted there.
    open_ = sizes.where("members > 1 AND (table = 0 OR least < most)").select(
        *bucket, F.ceil(F.col("members") / cell).alias("blocks")
    )
    met = dealt.drop("first").join(open_, bucket)
    block = F.pmod(F.xxhash64("node"), "blocks")
    paired = met.withColumn("block", block).select(
        *bucket, "node", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    )
    cells = paired.select(
        *bucket, "node", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    return _compare(cells.join(hashed, "node"), threshold)


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    cell: int = CELL,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors linked directly), ``component_id`` and ``kept`` of every row."""
    rows = staged(
        vectors.select(
            F.col(id_column).alias("vec_id"), F.when(usable(vector_column), F.col(vector_column)).alias("vector")
        ).withColumn("print", F.xxhash64("vector")),
        "vectors",
    )
    same = rows.where("vector IS NOT NULL").groupBy("print", "vector").agg(
        F.count("*").alias("times"), F.min("vec_id").alias("least")
    )
    nodes = staged(same.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = staged(linked_nodes(nodes.select("node", "vector", "times"), threshold, recall, cell, seed), "found")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("count").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    known = (
        nodes.join(counts, nodes["node"] == counts["a"], "left")
        .join(roots, "node", "left")
        .select("node", "print", "vector", "times", "least", "links", F.coalesce("root", "node").alias("root"))
    )
    known = staged(known, "rooted")
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    classes = known.join(least, "root").select(
        "print", F.col("vector").alias("same"), (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component"
    )
    met = rows.join(classes, (rows["print"] == classes["print"]) & (rows["vector"] == classes["same"]), "left")
    return met.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("same").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
