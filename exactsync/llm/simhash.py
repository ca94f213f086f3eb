"""Near-duplicates by SimHash, linked exactly with covering locality-sensitive hashing.

A fingerprint has 64 bits. For a radius r, every bit position gets a non-zero vector of r + 1 bits, and each
non-zero vector v of r + 1 bits is a table: its mask has the positions whose vector is not orthogonal to v. The vectors
of any r positions span at most r dimensions, so some v is orthogonal to all of them and its mask has none of those
positions: two fingerprints that differ in at most r positions meet in that table. No pair is missed.

Only different fingerprints enter the tables. A bucket of up to ``cell`` fingerprints is linked inside one task, which
gives back a spanning forest and never its pairs. Larger buckets are cut again, as often as needed: two members differ
only in positions outside the bucket's mask, so masks over those positions cover every pair as before.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; a text of one or
two words is one shingle; repeated rows share a class; rows with a null id take part, and a class without any id has a null
``component_id``; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.components import components
from exactsync.llm.shared import boundaries, runs, staged

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
CELL = 4096


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text; bytes methods know exactly the ASCII white space and the letters A-Z."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - [len(w) + 1 for w in words]).tolist()
        stops = (ends - 1)[words_per_shingle - 1 :].tolist()
        line, digest = b" ".join(words), xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=False)]
    ones = np.zeros(BITS, np.int64)
    every = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(every), 1 << 16):
        ones += np.unpackbits(every[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id`` and ``print`` (the fingerprint's bits as a signed long) of every row."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("print", T.LongType())]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, words_per_shingle) for t in batch.column("text").to_pylist()]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], schema.names)

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(measure, schema)


def masks(radius: int = RADIUS, positions: int = (1 << BITS) - 1) -> list[int]:
    """The covering masks over the given positions: 2^(radius+1) - 1 of them."""
    vectors = (1 << radius + 1) - 1
    out = [0] * vectors
    for order, bit in enumerate(b for b in range(BITS) if positions >> b & 1):
        vector = 1 + order % vectors
        for table in range(vectors):
            if (vector & (table + 1)).bit_count() % 2:
                out[table] |= 1 << bit
    return out


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> BITS - 1 else value


def _deal(rows: DataFrame, radius: int) -> DataFrame:
    """One row per fingerprint and table. ``fixed`` are the positions in which the bucket's members agree."""
    tables = [F.struct(F.lit(n).alias("table"), F.lit(_signed(m)).alias("mask")) for n, m in enumerate(masks(radius))]
    dealt = rows.select("print", F.explode(F.array(*tables)).alias("t"))
    return dealt.select(
        "print",
        F.col("t.mask").alias("fixed"),
        F.col("t.table").cast("long").alias("path"),
        F.col("print").bitwiseAND(F.col("t.mask")).alias("key"),
    )


def _deal_again(rows: DataFrame, radius: int) -> DataFrame:
    """Cut large buckets by masks over their free positions (different fingerprints agree in none of them all)."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("print", "fixed", "path", "key")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[int]] = {}
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            fixed = batch.column("fixed").to_numpy().view(np.uint64)
            paths = batch.column("path").to_numpy()
            for value in np.unique(fixed):
                here = np.flatnonzero(fixed == value)
                free = int(~value)
                if int(value) not in known:
                    known[int(value)] = masks(radius, free)
                for table, mask in enumerate(known[int(value)]):
                    wide = value | np.uint64(mask)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(prints[here].view(np.int64)),
                            pa.array(np.full(len(here), wide).view(np.int64)),
                            pa.array(paths[here] * 16 + table + 1),
                            pa.array((prints[here] & wide).view(np.int64)),
                        ],
                        schema.names,
                    )

    return rows.select("print", "fixed", "path").mapInArrow(cut, schema)


def _forest(prints: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect the members of a bucket as their pairs within ``radius`` do."""
    parents, children = [], []
    left = prints
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            node = todo.pop()
            near = np.bitwise_count(left ^ node) <= radius
            if near.any():
                found = left[near]
                parents.append(np.full(len(found), node))
                children.append(found)
                todo.extend(found)
                left = left[~near]
    return parents, children


def _link_cells(cells: DataFrame, radius: int) -> DataFrame:
    """Links inside buckets that each fit one task."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["path", "key", "fixed"]):
            ends = boundaries(table, ["path", "key", "fixed"])
            prints = table.column("print").to_numpy().view(np.uint64)
            left, right = [], []
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                if end - start == 2:
                    if int(prints[start] ^ prints[start + 1]).bit_count() <= radius:
                        left.append(prints[start : start + 1])
                        right.append(prints[start + 1 : end])
                elif end - start > 2:
                    parents, children = _forest(prints[start:end], radius)
                    left += parents
                    right += children
            if left:
                ends_of = [np.concatenate(x).astype(np.uint64).view(np.int64) for x in (left, right)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends_of], schema.names)

    placed = cells.select("path", "key", "fixed", "print").repartition("path", "key", "fixed")
    return placed.sortWithinPartitions("path", "key", "fixed").mapInArrow(link, schema)


def links(prints: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Links ``a``, ``b`` between different fingerprints (column ``print``, no repeats) that connect exactly what pairs
    within ``radius`` connect."""
    # With more free positions than this, every mask over them has some, so a larger bucket does get smaller.
    cell = max(cell, 1 << (1 << radius))
    key = ["path", "key", "fixed"]
    dealt, found = _deal(prints, radius), []
    while True:
        sizes = dealt.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1")
        full = staged(dealt.join(sizes, key), "cells")
        found.append(staged(_link_cells(full.where(F.col("members") <= cell), radius), "near"))
        large = full.where(F.col("members") > cell)
        if large.isEmpty():
            break
        dealt = staged(_deal_again(large, radius), "buckets")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words_per_shingle: int = SHINGLE,
    radius: int = RADIUS,
    cell: int = CELL,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` (smallest id of the class) of every row."""
    rows = staged(fingerprints(docs, id_column, text_column, words_per_shingle), "prints")
    different = staged(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "different")
    roots = components(links(different.select("print"), radius, cell))
    rooted = different.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    rooted = staged(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("print", "component_id")
    return rows.join(classes, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
