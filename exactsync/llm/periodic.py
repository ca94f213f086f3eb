"""Runs of repeating words, found with an enhanced suffix array and the test for branching tandems.

Texts are taken by chunks of about ``CHUNK_WORDS`` words (a longer text is a chunk of its own). The words of a chunk get numbers that
no two documents share, so the suffixes of a document are neighbours in the suffix array and no common prefix leaves it. A boundary
between neighbours with longest common prefix d splits an interval of suffixes that begin with the same d words in
two. For each suffix i of the smaller side, two look-ups in the inverse suffix array tell whether i + d or i - d is on the
other side: then two equal pieces of d words follow each other and differ in what comes next (a branching tandem). Each run has
exactly one with its period, at its end; rotated to the left as far as words agree, it covers the run. A stretch found again with a
multiple of its period is dropped. There are no tree nodes, and each suffix is on a smaller side at most log2(n) times.

Defined cases: a null text has no words, like an empty one; a text without runs keeps all words; repeated rows are judged each; a
text of any length is read whole, by the task that has its row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_WORDS = 1 << 17
#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
_PAIRS = 1 << 20

Run = tuple[int, int, int]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in their order, by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    held = symbols[order]
    fresh = np.append(True, held[1:] != held[:-1])[:n]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # the end comes first
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    places, width = _tied(fresh), 1
    while len(places):
        starts = order[places]
        group, after = rank[starts], rank[np.minimum(starts + width, n)]
        again = np.argsort(group * (n + 1) + after + 1, kind="stable")
        starts, group, after = starts[again], group[again], after[again]
        order[places] = starts
        new = np.append(True, (group[1:] != group[:-1]) | (after[1:] != after[:-1]))
        rank[starts] = np.maximum.accumulate(np.where(new, places, 0))
        places = places[_tied(new)]
        width *= 2
    return order


def _tied(fresh: np.ndarray) -> np.ndarray:
    """Places of the groups of two and more, where ``fresh`` marks the first of each group."""
    if not len(fresh):
        return np.zeros(0, np.int64)
    alone = fresh & np.append(fresh[1:], True)
    return np.flatnonzero(~alone)


def common_prefixes(symbols: np.ndarray, order: np.ndarray, inverse: np.ndarray) -> list[int]:
    """Longest common prefix of each suffix with the one before it in the order."""
    words, sorted_starts, n = [*symbols.tolist(), -1], order.tolist(), len(symbols)
    out, common = [0] * n, 0
    for start, place in enumerate(inverse.tolist()):
        if place:
            other = sorted_starts[place - 1]
            end = n - max(start, other)
            while common < end and words[start + common] == words[other + common]:
                common += 1
            out[place] = common
            if common:
                common -= 1
        else:
            common = 0
    return out


def _sides(prefixes: list[int], least: int) -> tuple[np.ndarray, ...]:
    """For each boundary with a common prefix and at least ``least`` suffixes around it: prefix, first of the
    left side, first of the right side and end of the right side."""
    n = len(prefixes)
    left, right = [0] * n, [n] * n
    stack, depths = [0], [-1]
    for place in range(1, n):
        depth = prefixes[place]
        while depths[-1] > depth:
            right[stack.pop()] = place
            depths.pop()
        left[place] = stack[-1]
        stack.append(place)
        depths.append(depth)
    depth, low, high = np.array(prefixes, np.int64), np.array(left, np.int64), np.array(right, np.int64)
    middle = np.flatnonzero((depth > 0) & (high - low >= least))
    return depth[middle], low[middle], middle, high[middle]


def branching_tandems(
    order: np.ndarray, inverse: np.ndarray, prefixes: list[int], least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares that cannot be moved to the right, by period."""
    depth, low, middle, high = _sides(prefixes, least)
    n = len(order)
    on_left = middle - low <= high - middle
    first, end = np.where(on_left, low, middle), np.where(on_left, middle, high)
    other, other_end = np.where(on_left, middle, low), np.where(on_left, high, middle)
    sizes = end - first
    ends = np.cumsum(sizes)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(sizes):  # about _PAIRS suffixes at a time
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, side="right")))
        count = sizes[at:to]
        which = np.repeat(np.arange(at, to), count)
        within = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        suffix, period = order[first[which] + within], depth[which]
        for step in (period, -period):
            partner = suffix + step
            inside = (partner >= 0) & (partner < n)
            place = inverse[np.where(inside, partner, 0)]
            hit = inside & (place >= other[which]) & (place < other_end[which])
            starts.append(np.minimum(suffix[hit], partner[hit]))
            periods.append(period[hit])
        at = to
    start, period = np.concatenate(starts), np.concatenate(periods)
    by_period = np.lexsort((start, period))
    return start[by_period], period[by_period]


def _rotated(symbols: np.ndarray, start: int, period: int) -> int:
    """How far to the left the words repeat with the period."""
    step = 16
    while start > 0:
        low = max(0, start - step)
        equal = symbols[low:start] == symbols[low + period : start + period]
        if not equal.all():
            return low + int(np.flatnonzero(~equal)[-1]) + 1
        start, step = low, step * 2
    return 0


def find_runs(symbols: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[Run]:
    """``(start, length, period)`` of every run, by start and period. Words of different documents must have different numbers.

    ``least_periods`` is 2 at least: with fewer a stretch has no square."""
    if len(symbols) < max(2, least_periods):
        return []
    order = suffix_array(symbols)
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.arange(len(order))
    prefixes = common_prefixes(symbols, order, inverse)
    # A run of k periods gives a boundary of its period at least k - 1 suffixes, one for each whole period but the last.
    starts, periods = branching_tandems(order, inverse, prefixes, least_periods)
    found: list[Run] = []
    at_end: dict[int, list[tuple[int, int]]] = {}
    for start, period in zip(starts.tolist(), periods.tolist(), strict=True):
        end, known = start + 2 * period, at_end.setdefault(start + 2 * period, [])
        if any(period % smaller == 0 and first <= start for first, smaller in known):
            continue  # the same stretch, counted with a multiple of its period
        first = _rotated(symbols, start, period)
        known.append((first, period))
        if end - first >= max(least_words, least_periods * period):
            found.append((first, end - first, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbered(documents: list[list[bytes]]) -> np.ndarray:
    """One number per word of all documents in turn: equal for equal words of a document, different between documents."""
    out, base = [], 0
    for words in documents:
        numbers: dict[bytes, int] = {}
        out.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) + base)
        base += len(numbers)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def runs_by_document(documents: list[list[bytes]], **least: int) -> list[list[Run]]:
    """The runs of each document of a chunk."""
    ends = np.cumsum([len(d) for d in documents])
    out: list[list[Run]] = [[] for _ in documents]
    for start, length, period in find_runs(numbered(documents), **least):
        which = int(np.searchsorted(ends, start, side="right"))
        out[which].append((start - int(ends[which]) + len(documents[which]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_FIELDS = ("n_runs", "start", "length", "period", "exponent_milli")


def _row(words: list[bytes], runs: list[Run]) -> tuple:
    """Columns of one document; the greatest run is the longest, of those the first, of those the one of least period."""
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    digests = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(collapsed(words, runs)))]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    whole = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (len(runs), *whole, *digests)


def scan(
    docs: DataFrame,
    rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_runs: bool = False,
    **least: int,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_runs``, the greatest run's ``start``, ``length``, ``period`` and ``exponent_milli``,
    ``runs_sha256`` and ``collapsed_sha256``; with ``with_runs`` also ``runs`` and ``collapsed``, the text without its repeats.

    ``rewrite`` may change a document's words (given its id) before they are read."""
    id_type = docs.schema[id_column].dataType
    fields = [T.StructField("doc_id", id_type), *(T.StructField(n, T.LongType()) for n in _FIELDS)]
    fields += [T.StructField(n, T.StringType()) for n in ("runs_sha256", "collapsed_sha256")]
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    if with_runs:
        fields += [T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]
    schema = T.StructType(fields)

    def out(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        rows = []
        for words, runs in zip(documents, runs_by_document(documents, **least), strict=True):
            more = ()
            if with_runs:
                named = [dict(zip(run.names, r, strict=True)) for r in runs]
                more = (named, b" ".join(collapsed(words, runs)).decode("utf-8"))
            rows.append((*_row(words, runs), *more))
        columns = [pa.array(ids, types[0]), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types[1:], strict=True))]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in fields]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, documents, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = (text.as_py() or "").encode("utf-8").split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                if ids and held + len(words) > CHUNK_WORDS:
                    yield out(ids, documents)
                    ids, documents, held = [], [], 0
                ids.append(doc_id)
                documents.append(words)
                held += len(words)
        if ids:
            yield out(ids, documents)

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(find, schema)
