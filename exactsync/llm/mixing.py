"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source has a weight and a target: its share of all tokens, stopped at ``most`` times its own
tokens, the excess being shared again by weight until no target is above its stop. Sources are dealt into
shards of bounded size. The whole mix has a fixed number of equal blocks of tokens, and each goes to the (source, shard)
cell with the highest quotient ``votes / (2 * blocks won + 1)``, so every cell has an integer quota. Inside a cell the
documents stand in a seeded order, their running total gives the blocks, and the quota takes the whole cell as often as it fits and the rest
as the blocks from a seeded start on (round the end to the first). All of that is integer arithmetic on offsets, no block
becomes a row.

The number of blocks won by a divisor d is ``floor(votes / d + 1/2)``, as the quotients of a cell fall, so the highest quotients are
found by narrowing d with a few sums over the cells; what is left between the last two divisors is ranked.

Defined cases: a null text has no tokens; a null source is a source of its own, after all others; an empty table or one without tokens gives
targets of zero; repeated rows are documents of their own (equal ids and texts in a cell share their place by row number); other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.shared import partition_count, staged

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20260
SHARD_ROWS = 256
BLOCK = 64
#: Blocks of the smallest target and of a source's mean cell at least: rounding to whole blocks stays below a percent.
FINENESS = 200
#: Quotients near the last divisor that are ranked rather than narrowed further.
_RANKED = 4096
_TRIALS = 48


def word_count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of ``text`` between ASCII white space (what ``bytes.split`` takes for white space)."""
    for batch in batches:
        sizes = [0 if t is None else len(t.encode("utf-8").split()) for t in batch.column("text").to_pylist()]
        at = batch.schema.get_field_index("text")
        columns, names = list(batch.columns), list(batch.schema.names)
        columns[at], names[at] = pa.array(sizes, pa.int64()), "size"
        yield pa.RecordBatch.from_arrays(columns, names)


def measured(rows: DataFrame) -> DataFrame:
    """Staged rows with ``size`` in place of ``text``, with ``mark`` (hash of id and text, which seeds all choices, so that
    they do not depend on how the input is partitioned) and with ``number``, the row's own number."""
    rows = rows.withColumn("mark", F.xxhash64("doc_id", "text"))
    schema = T.StructType([T.StructField("size", T.LongType()) if f.name == "text" else f for f in rows.schema.fields])
    counted = rows.mapInArrow(word_count, schema)
    if "number" not in rows.columns:
        counted = counted.withColumn("number", F.monotonically_increasing_id())
    return staged(counted, "sizes")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with a row number from 0 in the order of ``order`` (null last): a range partitioning, then a prefix sum over
    the row counts of its partitions."""
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField("lane", T.LongType()), T.StructField(name, T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            numbers = [pa.array(np.full(n, lane, np.int64)), pa.array(np.arange(done, done + n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], schema.names)
            done += n

    ranged = df.repartitionByRange(partition_count(spark), *order).sortWithinPartitions(*order)
    rows = staged(ranged.mapInArrow(number, schema), name)
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = rows.groupBy("lane").agg(F.count("*").alias("total"))
    shifts = lanes.select("lane", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shift"))
    placed = rows.join(F.broadcast(shifts), "lane")  # one row per shuffle partition
    return placed.withColumn(name, F.col(name) + F.col("shift")).drop("lane", "shift")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source``, ``source_size``, ``documents``, ``target``; the weights repeat over the sources by code point, null last."""
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "place")
    each = F.array(*(F.lit(float(w)) for w in weights))
    weighed = ranked.withColumn("weight", F.get(each, F.pmod("place", F.lit(len(weights))).cast("int")))
    weighed = staged(weighed.withColumn("stop", F.col("source_size") * float(most)), "sources")
    total = float(weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # tokens per unit of weight; only sources below their stop share it
    while total:
        stopped = F.col("stop") <= F.col("weight") * level
        spent, weight = weighed.agg(
            F.sum(F.when(stopped, F.col("stop"))), F.sum(F.when(~stopped, F.col("weight")))
        ).first()
        if not weight or (now := (total - (spent or 0.0)) / weight) <= level:
            break
        level = now
    target = F.least(F.col("stop"), F.col("weight") * level)
    return staged(weighed.select("source", "source_size", "documents", "place", target.alias("target")), "targets")


def _quota(divisor: float | Column) -> Column:
    """Blocks whose quotients reach a divisor, as far as the cell has them."""
    return F.least(F.col("stop"), F.floor(F.col("votes") / divisor + 0.5).cast("long"))


def apportion(cells: DataFrame, blocks: int) -> DataFrame:
    """``quota`` of every cell (columns ``cell``, ``votes`` > 0 and ``stop``, the most blocks a cell can take), ``blocks`` in all if the stops
    allow it. Ties go to the smaller cell."""
    total, room, top = cells.agg(F.sum("votes"), F.sum("stop"), F.max("votes")).first()
    if not blocks or not total:
        return cells.withColumn("quota", F.lit(0).cast("long"))
    if room <= blocks:
        return cells.withColumn("quota", F.col("stop"))
    low, high = 0.0, 2.0 * top + 1.0  # at high nobody wins a block, at low everybody takes all
    most, least = room, 0  # blocks won at low and at high
    first = np.linspace(0.5, 1.5, _TRIALS) * total / blocks
    while True:
        trials = first if first is not None else np.linspace(low, high, _TRIALS + 2)[1:-1]
        sums = cells.agg(*(F.sum(_quota(float(t))).alias(f"n{i}") for i, t in enumerate(trials))).first()
        before = (low, high)
        for trial, won in zip(trials, sums, strict=True):
            if won >= blocks and trial > low:
                low, most = float(trial), won
            elif won < blocks and trial < high:
                high, least = float(trial), won
        first = None
        if most - least <= _RANKED or (low, high) == before or high - low <= 1e-12 * high:
            break
    # Everything won at ``high`` is safe; of the rest, those that still win at ``low`` come by quotient.
    sure = cells.withColumn("quota", _quota(high))
    more = F.least(F.col("stop"), F.floor(F.col("votes") / low + 0.5).cast("long")) if low else F.col("stop")
    sure = staged(sure.withColumn("more", more - F.col("quota")), "quotas")
    left = blocks - sure.agg(F.sum("quota")).first()[0]
    seats = sure.where("more > 0").select(
        "cell", "votes", F.explode(F.expr("sequence(quota + 1, quota + more)")).alias("seat")
    )
    quotient = (F.col("votes") / (2 * F.col("seat") - 1)).desc()
    won = numbered(seats, [quotient, F.col("cell").asc()], "rank").where(F.col("rank") < left)
    extra = won.groupBy("cell").agg(F.count("*").alias("extra"))
    given = sure.join(extra, "cell", "left")
    return given.withColumn("quota", F.col("quota") + F.coalesce("extra", F.lit(0))).drop("extra", "more")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    block: int = BLOCK,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and what is taken: ``passes`` whole texts and the words of
    ``first`` to ``first_end`` and ``second`` to ``second_end`` (ends exclusive)."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), F.col(text_column).alias("text")
    )
    return _mix_sizes(measured(rows), weights, most, seed, block)


_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words_between(text: str, first: int, end: int) -> str:
    """The part of a text from word ``first`` up to word ``end``, that one not included."""
    data, start, stop = text.encode("utf-8"), None, 0
    for n, word in enumerate(_WORDS.finditer(data)):
        if n == first:
            start = word.start()
        if n == end - 1:
            stop = word.end()
            break
    return data[start:stop].decode("utf-8")


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    block: int = BLOCK,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    length_column: str = "n_chars",
) -> DataFrame:
    """What the mix takes, as documents with the same columns: a row per whole text taken, and one per part of a
    text with ``text_column`` cut to it (and ``length_column``, if there is one, its code points)."""
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(docs.columns))).alias("row"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = staged(whole, "rows")
    at = {c: docs.columns.index(c) for c in (id_column, text_column, source_column)}
    sizes = measured(
        rows.select(
            F.col(f"row.c{at[id_column]}").alias("doc_id"),
            F.col(f"row.c{at[source_column]}").alias("source"),
            F.col(f"row.c{at[text_column]}").alias("text"),
            "number",
        )
    )
    parts = ["passes", "size", "first", "first_end", "second", "second_end"]
    taken = _mix_sizes(sizes, weights, most, seed, block).where("taken > 0").select("number", *parts)
    fields = rows.schema["row"].dataType.fields
    length_at = docs.columns.index(length_column) if length_column in docs.columns else None
    text_at = at[text_column]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            plan = zip(*(batch.column(n).to_pylist() for n in parts), strict=True)
            index, new = [], []
            for row, (passes, size, *spans) in enumerate(plan):
                index += [row] * passes
                new += [None] * passes
                for first, end in (spans[:2], spans[2:]):
                    if end > first:
                        whole_text = (first, end) == (0, size)
                        index.append(row)
                        new.append(None if whole_text else words_between(texts[row].as_py(), first, end))
            chosen = pa.array(index, pa.int64())
            columns = [batch.column(n).take(chosen) for n in range(len(fields))]
            fresh = pa.array(new, columns[text_at].type)
            columns[text_at] = pc.coalesce(fresh, columns[text_at])
            if length_at is not None:
                lengths = pc.utf8_length(fresh).cast(columns[length_at].type)
                columns[length_at] = pc.coalesce(lengths, columns[length_at])
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    met = rows.join(taken, "number").select("row.*", *parts)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    out = met.mapInArrow(cut, schema)
    return out.toDF(*docs.columns)


def _mix_sizes(sizes: DataFrame, weights, most: int, seed: int, block: int) -> DataFrame:
    targets = source_targets(sizes, weights, most)
    shards = F.ceil(F.col("documents") / SHARD_ROWS)
    part = F.least(F.col("target"), F.col("source_size") / shards)
    total, smallest = targets.agg(F.sum("source_size"), F.min(F.when(part > 0, part))).first()
    total = total or 0
    unit = max(1, min(block, int((smallest or 0) / FINENESS)))
    known = targets.select(
        F.col("source").alias("from_source"), "source_size", "target", "place", shards.alias("shards")
    )
    dealt = sizes.join(known, sizes["source"].eqNullSafe(known["from_source"])).select(
        "doc_id",
        "size",
        "number",
        "mark",
        "source_size",
        "target",
        F.struct("place", F.pmod(F.xxhash64(F.lit(seed), "mark"), "shards").alias("shard")).alias("cell"),
    )
    dealt = dealt.withColumn("cell", (F.col("cell.place") * 2**32 + F.col("cell.shard")).cast("long"))
    order = Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(seed), "mark", F.lit(1)), "number")
    placed = staged(
        dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))), "cells"
    )
    cells = placed.groupBy("cell").agg(
        F.sum("size").alias("cell_size"), F.max("source_size").alias("source_size"), F.max("target").alias("target")
    )
    counted = cells.where("cell_size > 0 AND target > 0").select(
        "cell",
        "cell_size",
        (F.col("target") * F.col("cell_size") / F.col("source_size")).alias("votes"),
        (F.ceil(F.col("cell_size") / unit) * most).cast("long").alias("stop"),
    )
    quotas = apportion(staged(counted, "votes"), round(total / unit))
    blocks = F.ceil(F.col("cell_size") / unit)
    start = F.pmod(F.xxhash64(F.lit(seed), "cell", F.lit(2)), F.col("blocks")) * unit
    chosen = quotas.withColumn("blocks", blocks).select(
        F.col("cell").alias("of"),
        "cell_size",
        F.floor(F.col("quota") / F.col("blocks")).cast("long").alias("passes"),
        start.alias("from"),
        (start + F.pmod("quota", "blocks") * unit).alias("to"),
        (F.col("blocks") * unit).alias("round"),
    )
    rows = placed.join(chosen, placed["cell"] == chosen["of"], "left").withColumn("begin", F.col("end") - F.col("size"))

    def inside(at: Column) -> Column:
        """A place of the cell as a place of the document."""
        return F.greatest(F.lit(0), F.least(F.col("size"), at - F.col("begin"))).cast("long")

    zero = F.lit(0).cast("long")
    parts = {
        "passes": F.coalesce("passes", zero),
        "first": F.coalesce(inside(F.col("from")), zero),
        "first_end": F.coalesce(inside(F.least("to", "round")), zero),
        "second": zero,  # what goes round the end begins with the first block
        "second_end": F.coalesce(inside(F.greatest(F.lit(0), F.col("to") - F.col("round"))), zero),
    }
    done = rows.select("doc_id", "number", "size", "source_size", "target", *(c.alias(n) for n, c in parts.items()))
    again = F.when(F.col("first_end") > F.col("first"), F.col("first_end") - F.col("first")).otherwise(0)
    return done.withColumn("taken", F.col("passes") * F.col("size") + again + F.col("second_end"))
