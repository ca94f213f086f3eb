"""Source divergence audit: what sources of a language say more or less often than others, from sorted word pointers.

Terms are counted per shard, a few Arrow batches of whole documents: pointers to the word starts in the text buffers are
sorted by a multikey quicksort whose characters are eight bytes of the word, so the slices of a depth are split by one comparison
each and only words that go on are looked at again. A run of equal pointers is a term; the documents and sources of
its pointers give counts and document frequencies. Shards return counts, Spark adds them up, and words are never rows.

All arithmetic is in whole numbers (decimals where a product leaves 64 bits). For the sum of each pair of sources over all terms a
language is cut into slices of terms, as many as its counts need; each slice comes with the shares of all sources for terms they lack,
fills matrices of terms by sources and gives back one sum for each pair, so no source or language is in one task.

Defined cases: null text, language and source are empty strings; a text without terms still gives its language and source a
group; a language without kept terms has pairs of value 0 and no terms; a language with one source has no pairs; repeated rows
count as documents of their own; ties of value go by the item's bytes; an empty table gives no rows; texts of any length are read
whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.shared import boundaries, runs, staged

MIN_DOCUMENTS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
#: Bytes of text per shard (a longer batch is a shard of its own), and counts of a task that are held and added up before it hands them on.
SHARD_BYTES, HELD_COUNTS = 8 << 20, 1 << 20
_STREAMED = 1 << 16
#: Counts per slice of a language, and cells of the matrices of pairs.
SLICE_ROWS, MATRIX_CELLS = 200_000, 1 << 20
_BYTES = np.arange(256, dtype=np.uint8)
# What a term consists of, ASCII letters and all that is not ASCII; only A-Z are lowered.
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_IN_TERM = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
# The first so many of eight bytes.
_MASKS = np.array([(1 << 64) - (1 << 8 * (8 - n)) for n in range(9)], np.uint64)
_LOWERED = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)


def text_buffer(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, row after row with a space between them, and where each row ends in them."""
    batch = batch.cast(pa.large_string())
    offsets = np.frombuffer(batch.buffers()[1], np.int64)[batch.offset : batch.offset + len(batch) + 1]
    data = np.frombuffer(batch.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    return np.insert(data, ends, 0x20), ends + np.arange(1, len(ends) + 1)


def word_pointers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the terms."""
    inside = np.append(np.append(False, _IN_TERM[data]), False)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2] - edges[::2]


def _ranks(values: np.ndarray) -> np.ndarray:
    """Place of each value among the different ones."""
    order = np.argsort(values)
    held = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(np.append(False, held[1:] != held[:-1])[: len(held)])
    return out


def sorted_pointers(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, slices: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by slice and term, those of a term in any order, and where each run of equal ones starts.

    ``data`` is lowered and ends with eight zeros. At each depth the next eight bytes of the words (zeros after the end) are one
    character; a slice whose pointers agree in it and go on is a slice of the next depth."""
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    n, last = len(starts), len(data) - 8
    order = np.argsort(slices)
    held = slices[order]
    fresh = np.append(True, held[1:] != held[:-1])[:n]
    places, depth = np.arange(n), 0
    while len(places):
        pointers = order[places]
        left = lengths[pointers] - depth
        character = windows[np.minimum(starts[pointers] + depth, last)].view(">u8").ravel().astype(np.uint64)
        character &= _MASKS[np.clip(left, 0, 8)]
        of = np.cumsum(fresh[places])
        key = _ranks(character)
        again = np.argsort(of * (int(key.max()) + 1) + key)
        order[places] = pointers[again]
        character, of, left = character[again], of[again], left[again]
        new = np.append(True, (of[1:] != of[:-1]) | (character[1:] != character[:-1]))
        fresh[places] = new
        # A term has no zero byte, so pointers whose character has none go on; one that ended is the least of the next depth.
        alone = new & np.append(new[1:], True)
        places, depth = places[~alone & (left >= 8)], depth + 8
    return order, np.flatnonzero(fresh)


def _pieces(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The strings at the given places of a buffer."""
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    offsets = pa.py_buffer(np.append(0, ends).astype(np.int64))
    large = pa.Array.from_buffers(pa.large_string(), len(starts), [None, offsets, pa.py_buffer(data[at])])
    return large.cast(pa.string())


def shard_counts(texts: list[pa.Array], groups: np.ndarray, languages: np.ndarray) -> pa.Table:
    """``group``, ``term``, ``n`` and ``documents`` of a shard: rows of text, each with its group and that group's language."""
    buffers = [text_buffer(t) for t in texts]
    sizes = np.array([len(b[0]) for b in buffers], np.int64)
    data = np.concatenate([b[0] for b in buffers])
    ends = np.concatenate([b[1] + base for b, base in zip(buffers, np.cumsum(sizes) - sizes, strict=True)])
    starts, lengths = word_pointers(data)
    document = np.searchsorted(ends, starts, side="right")
    lowered = np.append(_LOWERED[data], np.zeros(8, np.uint8))
    order, runs = sorted_pointers(lowered, starts, lengths, languages[groups[document]])
    run = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
    # Each document of a run once, with its occurrences; then each group of a run once.
    many, rows = int(groups.max(initial=0)) + 1, max(1, len(ends))
    pairs, said = np.unique(run * rows + document[order], return_counts=True)
    keys, at = np.unique(pairs // rows * many + groups[pairs % rows], return_inverse=True)
    counts = np.bincount(at, weights=said, minlength=len(keys)).astype(np.int64)
    documents = np.bincount(at, minlength=len(keys))
    head = order[runs]
    terms = _pieces(lowered, starts[head], lengths[head]).take(pa.array(keys // many))
    return pa.table({"group": keys % many, "term": terms, "n": counts, "documents": documents})


def term_counts(docs: DataFrame, shard_bytes: int = SHARD_BYTES, held_counts: int = HELD_COUNTS) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``documents`` of every task; a key may come several times."""
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("lang", "source", "term")]
        + [T.StructField(n, T.LongType()) for n in ("n", "documents")]
    )

    class Task:
        """Counts of a task, its groups numbered as they come."""

        def __init__(self):
            self.names: dict[tuple, int] = {}
            self.languages: dict[str, int] = {}
            self.held: list[pa.Table] = []
            self.rows = 0

        def add(self, batches: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(batches)
            pairs = zip(table.column("lang").to_pylist(), table.column("source").to_pylist(), strict=True)
            groups = np.array([self.names.setdefault(p, len(self.names)) for p in pairs], np.int64)
            languages = [self.languages.setdefault(lang, len(self.languages)) for lang, _ in self.names]
            self.held.append(shard_counts(table.column("text").chunks, groups, np.array(languages, np.int64)))
            self.rows += self.held[-1].num_rows

        def handed(self) -> Iterator[pa.RecordBatch]:
            if not self.held:
                return
            whole = pa.concat_tables(self.held)
            if len(self.held) > 1:
                whole = whole.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("documents", "sum")])
                whole = whole.rename_columns(["group", "term", "n", "documents"])
            self.held, self.rows = [], 0
            sides = [pa.array([name[side] for name in self.names], pa.string()) for side in (0, 1)]
            for batch in whole.to_batches(max_chunksize=20_000):
                group = batch.column("group")
                columns = [*(side.take(group) for side in sides), *(batch.column(c) for c in ("term", "n", "documents"))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, size = Task(), [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            bytes_of = batch.column("text").nbytes
            if held and size + bytes_of > shard_bytes:
                task.add(held)
                held, size = [], 0
                if task.rows > held_counts:
                    yield from task.handed()
            held.append(batch)
            size += bytes_of
        if held:
            task.add(held)
        yield from task.handed()

    return docs.mapInArrow(count, schema)


def _changes(table: pa.Table, names: list[str]) -> np.ndarray:
    """Where a row differs from the one before in any of the columns; true for the first."""
    changed = np.zeros(table.num_rows, bool)
    changed[:1] = True
    for name in names:
        values = table.column(name).combine_chunks()
        changed[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    return changed


def _merged(table: pa.Table) -> pa.Table:
    """One row for each term, language and source."""
    keys = ["mixed", "term", "lang", "source"]
    return table.group_by(keys, use_threads=False).aggregate([("n", "sum"), ("documents", "sum")]).rename_columns([*keys, "n", "documents"])


def _together(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows with those of a term and language next to each other, and where these begin."""
    names = ["mixed", "term", "lang"]
    table = table.take(pa.array(np.argsort(table.column("mixed").to_numpy())))
    first = _changes(table, names)
    if first.sum() != len(pc.unique(table.column("mixed"))):  # two terms share a hash
        table = table.take(pc.sort_indices(table, [(n, "ascending") for n in names]))
        first = _changes(table, names)
    return table, first


def kept_counts(found: DataFrame, min_documents: int) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n``, the term's ``lang_n`` in its language and whether the row is the ``first`` of these,
    for the terms of enough documents. Counts are added up in a stream over rows sorted by a hash of the term and language, which is
    cheaper than by strings; what waits for the next rows is one row for each source of a term."""

    def kept(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows, first = _together(_merged(table))
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, rows.num_rows))
        lang_n, documents = (np.repeat(np.add.reduceat(rows.column(c).to_numpy(), starts), sizes) for c in ("n", "documents"))
        out = rows.select(["lang", "source", "term", "n"]).append_column("lang_n", pa.array(lang_n)).append_column("first", pa.array(first))
        yield from out.filter(pa.array(documents >= min_documents)).combine_chunks().to_batches()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size < _STREAMED:
                continue
            table = pa.concat_tables(waiting)
            last = int(np.flatnonzero(_changes(table, ["mixed"]))[-1])
            if last:
                yield from kept(table.slice(0, last))
            waiting, size = [_merged(table.slice(last))], 0
        if waiting:
            yield from kept(pa.concat_tables(waiting))

    mixed = F.xxhash64("term", "lang").alias("mixed")
    rows = found.repartition("lang", "term").select(mixed, "term", "lang", "source", "n", "documents").sortWithinPartitions("mixed")
    return rows.mapInArrow(stream, "lang string, source string, term string, n long, lang_n long, first boolean")


def _share(count, total, terms):
    """1 + floor(UNIT * (count + 1) / (total + terms)), exactly."""
    whole = lambda c: c.cast("decimal(20,0)")
    product = F.lit(UNIT).cast("decimal(10,0)") * whole(count + 1)
    long = F.call_function("div", product, whole(total + terms))
    short = F.call_function("div", F.lit(UNIT).cast("long") * (count + 1), total + terms)
    return F.when(count < 2**62 // UNIT, short).otherwise(long) + 1


def _deviation(p, q):
    """floor((p - q) * (p - q) / q); shares are at most UNIT + 1, so squares stay inside 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(kept: DataFrame, groups: DataFrame, slice_rows: int, cells: int) -> DataFrame:
    """``lang``, ``a``, ``b``, ``value``: for places a and b of a language's sources the sum of deviations over all kept terms.

    ``kept`` has a row for each term and source that says it: its place, its share and whether it is the term's first."""
    slices = F.call_function("div", F.col("lang_rows"), F.lit(slice_rows).cast("long")) + 1
    said = kept.select(
        "lang", F.pmod(F.xxhash64("term"), slices).alias("slice"), F.lit(1).alias("kind"), "term", "place", "first", F.col("p").alias("share")
    )
    lacking = groups.where("terms > 0").select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("slice"),
        F.lit(0).alias("kind"),
        F.lit("").alias("term"),
        "place",
        F.lit(False).alias("first"),
        _share(F.lit(0).cast("long"), F.col("total"), F.col("terms")).alias("share"),
    )
    mixed = F.xxhash64("term")  # numbers are compared faster than terms
    order = ("slice", "lang", "kind", mixed, "term", F.desc("first"), "place")
    rows = said.unionByName(lacking).repartition("slice", "lang").sortWithinPartitions(*order)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["slice", "lang"]):
            ends = boundaries(table, ["slice", "lang"])
            kinds, first = table.column("kind").to_numpy(), table.column("first").to_numpy()
            places, shares = table.column("place").to_numpy(), table.column("share").to_numpy()
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                width = int((kinds[start:end] == 0).sum())
                base, sums = shares[start : start + width], np.zeros((width, width), np.int64)
                start += width
                heads = start + np.flatnonzero(first[start:end])
                step = max(1, cells // width)
                for at in range(0, len(heads), step):
                    low, high = heads[at], heads[at + step] if at + step < len(heads) else end
                    part = np.tile(base, (min(step, len(heads) - at), 1))
                    part[np.cumsum(first[low:high]) - 1, places[low:high]] = shares[low:high]
                    for a in range(width):
                        gap = part[:, a, None] - part
                        sums[a] += (gap * gap // part).sum(axis=0)
                a, b = np.nonzero(sums)
                name = pa.array([table.column("lang")[int(start - 1)].as_py()] * len(a), pa.string())
                yield pa.RecordBatch.from_arrays([name, *map(pa.array, (a, b, sums[a, b]))], ["lang", "a", "b", "value"])

    columns = ["lang", "slice", "kind", "place", "first", "share"]
    found = rows.select(*columns).mapInArrow(add, "lang string, a long, b long, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP_TERMS,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
    shard_bytes: int = SHARD_BYTES,
    held_counts: int = HELD_COUNTS,
    slice_rows: int = SLICE_ROWS,
    cells: int = MATRIX_CELLS,
) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value`` and ``rank``.

    Part ``pair`` compares a source with each other one of its language over all kept terms, part ``term`` lists the ``top``
    kept terms that a source has more often than its language has. Kept are the terms of ``min_documents`` documents of the language."""
    named = {"lang": lang_column, "source": source_column, "text": text_column}
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for n, c in named.items()))
    kept = staged(kept_counts(term_counts(rows, shard_bytes, held_counts), min_documents), "kept")
    zero = F.lit(0).cast("long")
    totals = staged(
        kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("terms"), F.count("*").alias("rows")), "totals"
    )
    sizes = totals.groupBy("lang").agg(F.sum("terms").alias("terms"), F.sum("total").alias("lang_total"), F.sum("rows").alias("lang_rows"))
    groups = rows.select("lang", "source").distinct().join(totals.select("lang", "source", "total"), ["lang", "source"], "left")
    groups = groups.join(sizes, "lang", "left").select(
        "lang",
        "source",
        *(F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total", "lang_rows")),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("place"),
    )
    groups = staged(groups, "groups")
    p = _share(F.col("n"), F.col("total"), F.col("terms"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    said = kept.join(groups, ["lang", "source"]).withColumns({"p": p, "q": q})

    one = groups.select("lang", "source", F.col("place").alias("a"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"))
    sums = _pair_sums(said, groups, slice_rows, cells)
    pairs = one.join(two, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))
    more = said.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _deviation(F.col("p"), F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    return ranked.unionByName(more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
