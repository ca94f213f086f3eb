"""Near copies by the Jaccard similarity of five-word shingles: SimHash and MinHash bands propose, whole shingle sets decide.

A text's set of shingle hashes gets a SimHash fingerprint and ``BANDS`` keys of ``ROWS`` minima each. Fingerprints within ``simhash.RADIUS``
bits (the covering hash of ``simhash.links``, a forest, never its pairs) link most copies; they count once their whole sets
are similar. What fingerprints miss meets in the buckets of the keys: two texts of similarity s share a key but for a
chance of (1 - s^ROWS)^BANDS, which is 3e-6 at s = 0.8 and less above; a key takes several shingles, so a passage
that many texts share does not bring them together.

Equal sets become one member before anything is paired. Buckets whose members are linked already are done. Of the others the sets
are sent once per bucket to *cells* of at most ``CELL`` members and ``CELL_SHINGLES`` shingles, where all pairs
are compared exactly by one product of matrices; a cell gives back a spanning forest, never its pairs, so rows grow with members.
The largest linked class of a bucket is its core. Cells hold every pair of the others, and every pair of others and core, so a
straggler meets a huge core in blocks. If a bucket has more than ``MOST_BLOCKS`` cells of others, its cells do not all meet. It is cut
by ``FINER_BANDS`` keys of ``FINER_ROWS`` further minima, up to ``DEPTH`` times, which links most of what is similar; the rest is exact:
all members of such buckets meet by prefixes. Shingles are put in order, the rarest first. Of two sets of similarity s the
first common shingle stands in both among the first ``size - ceil(s * size) + 1``, so the buckets of these shingles hold every
similar pair, and all their cells meet: nothing is dropped.

Defined cases: a text of one to four words is one shingle; null and empty texts have no shingles and are one
class; white space and letters count as in ``simhash``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm import simhash
from exactsync.llm.components import components
from exactsync.llm.shared import boundaries, digest, runs, staged

SHINGLE = 5
SEED = 42
#: Least similarity, as a fraction.
SIMILARITY = (4, 5)
BANDS, ROWS = 32, 5
#: Members and shingles of a cell, and cells of others that a bucket may have before it is cut again.
CELL, CELL_SHINGLES, MOST_BLOCKS = 512, 1 << 21, 8
FINER_BANDS, FINER_ROWS, DEPTH = 16, 8, 1
_COLUMNS = 1 << 14
_CHUNK = 256


class _Minima:
    """Functions that give the keys of one level: ``bands`` keys of ``rows`` minima."""

    def __init__(self, level: int, bands: int, rows: int):
        drawn = np.random.default_rng(SEED + level)
        self.bands, self.rows = bands, rows
        self.xors = drawn.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
        self.factors = drawn.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.mixers = drawn.integers(0, 1 << 64, (bands, rows), dtype=np.uint64) | np.uint64(1)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """A key for each band of minima (none for an empty set)."""
        if not len(hashes):
            return np.zeros(0, np.uint64)
        high = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.bands * self.rows, (1 << 32) - 1, np.uint32)
        for at in range(0, len(high), _CHUNK):
            mixed = (high[at : at + _CHUNK, None] ^ self.xors) * self.factors
            np.minimum(least, mixed.min(axis=0), out=least)
        return ((least.reshape(self.bands, self.rows) + np.uint64(1)) * self.mixers).sum(axis=1, dtype=np.uint64)


def shingles(text: str | None, words_per_shingle: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of a text's shingles, each once."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < words_per_shingle:
        return np.array([digest(line, SEED)], np.uint64)
    sizes = np.array([len(w) for w in words]) + 1
    stops = np.cumsum(sizes)
    starts = (stops - sizes).tolist()
    ends = (stops - 1)[words_per_shingle - 1 :].tolist()
    return np.unique(np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=False)], np.uint64))


def print_of(hashes: np.ndarray) -> int:
    """SimHash of a set: a bit is 1 if it is set in over half of the hashes; an empty set has 0."""
    ones = np.zeros(64, np.int64)
    every = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(every), 1 << 16):
        ones += np.unpackbits(every[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def similar(size_a: int, size_b: int, common: int) -> bool:
    """Whether common / (size_a + size_b - common) reaches the least similarity."""
    over, under = SIMILARITY
    return common * under >= over * (size_a + size_b - common)


def _lists(keys: list[np.ndarray]) -> pa.ListArray:
    ends = np.append(0, np.cumsum([len(k) for k in keys])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)))


def _measured(rows: DataFrame) -> DataFrame:
    """Two halves of the set's digest, its fingerprint, its size and its keys, per row."""
    names = ["doc", "d1", "d2", "print", "size"]
    fields = [T.StructField(n, T.LongType()) for n in names]
    schema = T.StructType([*fields, T.StructField("keys", T.ArrayType(T.LongType()))])
    minima = _Minima(0, BANDS, ROWS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, prints, sizes, keys = [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py())
                digests.append(xxhash.xxh3_128_digest(found.tobytes(), SEED))
                prints.append(print_of(found))
                sizes.append(len(found))
                keys.append(minima.keys(found))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            signed = np.array(prints, np.uint64).view(np.int64)
            columns = [pa.array(x) for x in (halves[:, 0], halves[:, 1], signed, np.array(sizes, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns, _lists(keys)], schema.names)

    return rows.mapInArrow(measure, schema)


def _sets(rows: DataFrame) -> DataFrame:
    """``doc`` and ``hashes``, the bytes of its sorted set."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, pa.binary())], ["doc", "hashes"])

    return rows.mapInArrow(hashed, "doc long, hashes binary")


def _finer_keys(sets: DataFrame, level: int) -> DataFrame:
    """``doc``, ``band`` and ``finer``: keys of further minima."""
    minima = _Minima(level, FINER_BANDS, FINER_ROWS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [minima.keys(np.frombuffer(h.as_py(), np.uint64)) for h in batch.column("hashes")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), _lists(keys)], ["doc", "keys"])

    return sets.mapInArrow(measure, "doc long, keys array<long>").select("doc", F.posexplode("keys").alias("band", "finer"))


def _prefixes(sets: DataFrame, members: DataFrame) -> DataFrame:
    """``key``, ``doc`` and ``size``: exact buckets of ``members`` (``doc``, ``size``), two similar sets share at least one.

    A shingle of one set alone takes a place in the prefix but makes no bucket."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(h.as_py(), np.uint64) for h in batch.column("hashes")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), _lists(found)], ["doc", "keys"])

    every = sets.join(members.hint("merge"), "doc").select("doc", "hashes").mapInArrow(listed, "doc long, keys array<long>")
    shingled = staged(every.select("doc", F.explode("keys").alias("key")), "shingles")
    common = shingled.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = shingled.join(common.hint("merge"), "key").join(members.hint("merge"), "doc")
    own, (over, under) = Window.partitionBy("doc"), SIMILARITY
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "key"))
    least = F.ceil(F.col("size") * over / under)
    return shared.withColumn("place", place).where(F.col("place") <= F.col("size") - least + 1).select("key", "doc", "size")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("one"), batch.column("two"), strict=True):
                one, two = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                good.append(similar(len(one), len(two), len(np.intersect1d(one, two, assume_unique=True))))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("doc").alias("a"), F.col("hashes").alias("one"))
    right = sets.select(F.col("doc").alias("b"), F.col("hashes").alias("two"))
    met = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return met.select("a", "b", "one", "two").mapInArrow(compare, "a long, b long")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets have in common."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    fresh = np.append(True, every[1:] != every[:-1])
    element = np.cumsum(fresh) - 1
    several = np.bincount(element) > 1  # an element of one set alone is common to none
    kept = several[element]
    owner, element = owner[kept], (np.cumsum(several) - 1)[element[kept]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(several.sum()), _COLUMNS):
        first, end = np.searchsorted(element, (low, low + _COLUMNS))
        dense = np.zeros((len(sets), _COLUMNS), np.float32)
        dense[owner[first:end], element[first:end] - low] = 1
        common += dense @ dense.T  # whole numbers below 2^24: exact
    return common.astype(np.int64)


def forest(sets: list[np.ndarray], roots: np.ndarray) -> tuple[list[int], list[int]]:
    """Links between similar sets that, with the given roots, connect the members as all their pairs do."""
    sizes, (over, under) = np.array([len(s) for s in sets]), SIMILARITY
    common = common_counts(sets)
    near = common * under >= over * (sizes[:, None] + sizes - common)
    one, two = [], []
    left = np.ones(len(sets), bool)
    while left.any():
        todo = [int(left.argmax())]
        left[todo[0]] = False
        while todo:
            node = todo.pop()
            known = left & (roots == roots[node])
            found = left & near[node] & ~known
            left &= ~(known | found)
            one += [node] * int(found.sum())
            two += np.flatnonzero(found).tolist()
            todo += np.flatnonzero(known | found).tolist()
    return one, two


def _linked(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links inside the cells (rows ``cell``, ``doc``, ``root``)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["cell"]):
            ends = boundaries(table, ["cell"])
            docs, roots, hashes = table.column("doc").to_numpy(), table.column("root").to_numpy(), table.column("hashes")
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                if (roots[start:end] != roots[start]).any():
                    met = [np.frombuffer(hashes[n].as_py(), np.uint64) for n in range(start, end)]
                    one, two = forest(met, roots[start:end])
                    if one:
                        ends_of = [pa.array(docs[start:end][side]) for side in (one, two)]
                        yield pa.RecordBatch.from_arrays(ends_of, ["a", "b"])

    met = cells.join(sets.hint("merge"), "doc").select("cell", "doc", "root", "hashes")
    return met.repartition("cell").sortWithinPartitions("cell").mapInArrow(link, "a long, b long")


def _dealt(buckets: DataFrame, roots: DataFrame, cell: int, most_blocks: int, last: bool) -> tuple[DataFrame, DataFrame]:
    """Cells of the buckets (rows ``key``, ``doc``, ``size``) that hold several classes, and the rows of buckets to be cut again.

    Those are dealt into blocks alone, so that what is similar is linked before the cut."""
    rooted = buckets.join(roots.withColumnRenamed("node", "doc").hint("merge"), "doc", "left")
    rooted = rooted.select("key", "doc", "size", F.coalesce("root", "doc").alias("root"))
    marks = {f"mark{n}": F.bit_xor(h) for n, h in enumerate(digest(F.col("doc")))}
    classes = rooted.groupBy("key", "root").agg(
        F.count("*").alias("n"), F.sum("size").alias("s"), *(x.alias(n) for n, x in marks.items())
    )
    stats = classes.groupBy("key").agg(
        F.sum("n").alias("members"),
        F.sum("s").alias("shingles"),
        F.max(F.struct("n", "s", "root")).alias("core"),
        F.count("*").alias("classes"),
        *(F.bit_xor(n).alias(n) for n in marks),
    )

    def blocks(members, shingles):
        return F.greatest(F.ceil(members / cell), F.ceil(shingles / CELL_SHINGLES)).cast("long")

    # Several bands often bring together exactly the same members: one of these buckets is enough.
    stats = stats.where("classes > 1")
    same = [c for c in stats.columns if c not in ("key", "classes", "core")]
    stats = stats.groupBy(*same).agg(F.min(F.struct("key", "core")).alias("least")).select("least.*", *same)
    stats = stats.select(
        "key",
        F.col("core.root").alias("core"),
        blocks(F.col("members"), F.col("shingles")).alias("all_blocks"),
        blocks(F.col("core.n"), F.col("core.s")).alias("core_blocks"),
        blocks(F.col("members") - F.col("core.n"), F.col("shingles") - F.col("core.s")).alias("other_blocks"),
    )
    large = F.lit(False) if last else F.col("other_blocks") > most_blocks
    rows = staged(rooted.join(stats.withColumn("large", large).hint("merge"), "key"), "rooted")
    mixed = F.xxhash64("doc", "key")
    drawn = lambda n: F.pmod(mixed, F.col(n))
    place = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    zero, core = F.lit(0).cast("long"), F.col("root") == F.col("core")
    own = drawn("other_blocks")
    other = F.concat(
        F.transform(upto("other_blocks"), lambda j: place("others", F.least(own, j), F.greatest(own, j))),
        F.transform(upto("core_blocks"), lambda i: place("core", i, own)),
    )
    where = (
        F.when(F.col("all_blocks") == 1, F.array(place("whole", zero, zero)))
        .when(F.col("large"), F.array(place("block", drawn("all_blocks"), zero)))
        .when(core, F.transform(upto("other_blocks"), lambda j: place("core", drawn("core_blocks"), j)))
        .otherwise(other)
    )
    cells = rows.select("doc", "root", "key", F.explode(where).alias("at"))
    cells = cells.select("doc", "root", F.xxhash64("key", "at.kind", "at.i", "at.j").alias("cell"))
    return cells, rows.where("large").select("key", "doc", "size")


def firsts(
    docs: DataFrame,
    id_column: str,
    text_column: str = "text",
    cell: int = CELL,
    most_blocks: int = MOST_BLOCKS,
    depth: int = DEPTH,
) -> DataFrame:
    """``doc``: the smallest id (a whole number, no repeats) of each class of texts that links of similarity connect."""
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc"), F.col(f"`{text_column}`").alias("text"))
    measured = staged(_measured(rows), "sets")
    members = staged(measured.groupBy("d1", "d2").agg(F.min("doc").alias("doc")).select("doc"), "members")
    different = staged(measured.join(members.hint("merge"), "doc", "left_semi").select("doc", "print", "size", "keys"), "different")

    dealt = different.select("doc", "size", F.explode("keys").alias("key"))
    several = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = staged(dealt.join(several.hint("merge"), "key").select("key", "doc", "size"), "buckets")

    prints = staged(different.where("size > 0").groupBy("print").agg(F.min("doc").alias("first")), "prints")
    near = simhash.links(prints.select("print"))
    ends = prints.select(F.col("print").alias("a"), F.col("first").alias("x")), prints.select(F.col("print").alias("b"), F.col("first").alias("y"))
    across = near.join(ends[0].hint("merge"), "a").join(ends[1].hint("merge"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    same = different.where("size > 0").join(prints.hint("merge"), "print").where("doc > first")
    proposed = staged(across.unionByName(same.select(F.col("first").alias("a"), F.col("doc").alias("b"))), "proposed")

    wanted = buckets.select("doc").unionByName(proposed.select(F.col("a").alias("doc"))).unionByName(proposed.select(F.col("b").alias("doc")))
    sets = staged(_sets(rows.join(wanted.distinct().hint("merge"), "doc", "left_semi")), "hashes")
    links = staged(_compared(proposed, sets), "similar")
    crowded = None
    for level in range(depth + 1):
        cells, large = _dealt(buckets, components(links), cell, most_blocks, False)
        links = links.unionByName(staged(_linked(cells, sets), "similar"))
        if large.isEmpty():
            break
        if crowded is None:  # later buckets are parts of these
            crowded = staged(large.select("doc", "size").distinct(), "crowded")
        if level < depth:
            finer = _finer_keys(sets.join(large.select("doc").distinct().hint("merge"), "doc", "left_semi"), level + 1)
            cut = large.join(finer.hint("merge"), "doc").select(F.xxhash64("key", "band", "finer").alias("key"), "doc", "size")
            buckets = staged(cut, "buckets")
    if crowded is not None:
        cells, _ = _dealt(staged(_prefixes(sets, crowded), "buckets"), components(links), cell, most_blocks, True)
        links = links.unionByName(staged(_linked(cells, sets), "similar"))
    rooted = members.join(components(links).withColumnRenamed("node", "doc"), "doc", "left")
    return rooted.where("root IS NULL OR root = doc").select("doc")
