"""URL filters: allow and block entries in a trie over reversed host labels and path segments; the longest match decides.

An entry is a host, a path and a verdict. It fits a URL whose host is its own or a subdomain of it and whose path starts
with its path. The entry with most host labels wins, among those the one with the longest path; of equal entries ``block`` wins.
A URL that no entry fits gets ``default``. An entry without host fits every host; an entry's path that ends inside a segment
fits every segment that starts so.

A list of at most ``TRIE_BYTES`` of hosts and paths, which is measured, becomes one trie that is broadcast, and URLs are judged in a
narrow stage. A larger list is never brought together: each URL deals a row for each pair of a host suffix and a directory, no longer than
the list has any, and meets the entries with these in a join.

Defined cases: of a null URL and of one without ``://`` host and path are empty; empty tables give no rows; without entries every URL
gets ``default``; repeated rows are judged each, ties are settled as above; URLs of any length are read whole; letters other than
A-Z keep their case; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.shared import ascii_lower, staged

ALLOW, BLOCK = "allow", "block"
#: Entries and bytes of the hosts and paths in a trie that is broadcast.
TRIE_ENTRIES, TRIE_BYTES = 200_000, 16 << 20
_ENTRIES = "host string, path string, verdict string"


class Trie:
    """Nodes are [labels, segments, stems, verdict]: dicts of host labels and whole path segments, and for the
    parts of segments at which entries end their verdicts."""

    def __init__(self, entries: Iterable[tuple[str, str, str]]):
        self.root = self._node()
        for host, path, verdict in entries:
            self._add(host, path, verdict)

    @staticmethod
    def _node() -> list:
        return [{}, {}, {}, None]

    @staticmethod
    def _stronger(old: tuple | None, new: tuple) -> tuple:
        return new if old is None or new[2] == BLOCK else old

    def _add(self, host: str, path: str, verdict: str) -> None:
        entry, node = (host, path, verdict), self.root
        for label in reversed(host.split(".")) if host else ():
            node = node[0].setdefault(label, self._node())
        *whole, stem = path.split("/")
        for segment in whole:
            node = node[1].setdefault(segment, self._node())
        if stem:
            node[2][stem] = self._stronger(node[2].get(stem), entry)
        else:
            node[3] = self._stronger(node[3], entry)

    @staticmethod
    def _longest(node: list, path: str) -> tuple | None:
        """The entry of the longest path, with all labels read already."""
        found, start = node[3], 0
        while node is not None:
            end = path.find("/", start)
            segment = path[start:] if end < 0 else path[start:end]
            stems = node[2]
            if stems:
                hit = max((s for s in map(len, stems) if s <= len(segment) and segment[:s] in stems), default=0)
                found = stems[segment[:hit]] if hit else found
            node = node[1].get(segment) if end >= 0 else None
            if node is not None and node[3] is not None:
                found = node[3]
            start = end + 1
        return found

    def match(self, host: str, path: str) -> tuple | None:
        """The entry (host, path, verdict) that decides."""
        node = self.root
        found = self._longest(node, path)
        for label in reversed(host.split(".")) if host else ():
            node = node[0].get(label)
            if node is None:
                break
            found = self._longest(node, path) or found
        return found


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL."""
    cut = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return ascii_lower(cut("://([^/?#]*)")), cut("://[^/?#]*([^?#]*)")


def entries_of(spark: SparkSession, entries: Iterable[tuple[str, str, str]]) -> DataFrame:
    """A list of (verdict, host, path) as a table."""
    return spark.createDataFrame([(h, p, v) for v, h, p in entries], _ENTRIES)


def _clean(entries: DataFrame) -> DataFrame:
    host = ascii_lower(F.coalesce("host", F.lit("")))
    return entries.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where(
        F.col("verdict").isin(ALLOW, BLOCK)
    )


def _by_trie(urls: DataFrame, entries: list[tuple[str, str, str]]) -> DataFrame:
    """``urls`` with the deciding entry's ``rule`` and ``found`` verdict, from a broadcast trie."""
    shared = urls.sparkSession.sparkContext.broadcast(entries)
    tries: dict[str, Trie] = {}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "trie" not in tries:
            tries["trie"] = Trie(shared.value)
        match = tries["trie"].match
        for batch in batches:
            pairs = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            found = [match(host, path) for host, path in pairs]
            rules = pa.array([None if e is None else e[0] + e[1] for e in found], pa.string())
            verdicts = pa.array([None if e is None else e[2] for e in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rules, verdicts], [*batch.schema.names, "rule", "found"])

    extra = [T.StructField(n, T.StringType()) for n in ("rule", "found")]
    return urls.mapInArrow(judge, T.StructType([*urls.schema.fields, *extra]))


def _by_join(urls: DataFrame, entries: DataFrame, labels: int, depth: int) -> DataFrame:
    """The same from a join, for lists that are too large for a trie; ``labels`` and ``depth`` are the most that any entry has.

    The key of an entry is its host and its path up to the last slash; what follows that is compared after the join."""
    numbered = staged(urls.withColumn("number", F.monotonically_increasing_id()), "urls")
    cut = F.length("path") - F.length(F.substring_index("path", "/", -1))
    keyed = entries.select(
        "verdict",
        F.col("host").alias("suffix"),
        F.substr("path", F.lit(1), cut).alias("folder"),
        F.substr("path", cut + 1).alias("stem"),
        F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", "[.]"))).alias("labels"),
    )
    host, path = F.split("host", "[.]"), F.split("path", "/", -1)
    suffixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(host), F.lit(labels))),
        lambda n: F.array_join(F.slice(host, F.size(host) - n + 1, n), "."),
    )
    folders = F.transform(
        F.sequence(F.lit(0), F.least(F.size(path) - 1, F.lit(depth))),
        lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(path, 1, n), "/"), F.lit("/"))),
    )
    dealt = numbered.select("number", "path", "host", F.explode(F.array_distinct(suffixes)).alias("suffix")).select(
        "number", "path", "suffix", F.explode(folders).alias("folder")
    )
    met = dealt.join(keyed, ["suffix", "folder"]).where(
        F.startswith(F.substr("path", F.length("folder") + 1), F.col("stem"))
    )
    strength = F.struct(
        "labels",
        (F.length("folder") + F.length("stem")).alias("length"),
        (F.col("verdict") == BLOCK).alias("block"),
        F.concat("suffix", "folder", "stem").alias("rule"),
        "verdict",
    )
    best = met.groupBy("number").agg(F.max(strength).alias("best"))
    judged = numbered.join(best, "number", "left")
    return judged.select(*urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("found"))


def judge(
    pages: DataFrame,
    entries: DataFrame,
    default: str = ALLOW,
    id_column: str = "page_id",
    url_column: str = "url",
    trie_bytes: int = TRIE_BYTES,
    trie_entries: int = TRIE_ENTRIES,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (host and path of the entry that decides, or null) and ``verdict`` of every row.

    ``entries`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``; others are no entries)."""
    host, path = parts(F.col(url_column))
    urls = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    clean = _clean(entries)
    size = clean.agg(
        F.count("*"),
        F.sum(F.octet_length("host") + F.octet_length("path")),
        F.max(F.size(F.split("host", "[.]"))),
        F.max(F.size(F.split("path", "/", -1)) - 1),
    ).first()
    if size[0] <= trie_entries and (size[1] or 0) <= trie_bytes:
        judged = _by_trie(urls, [tuple(r) for r in clean.collect()])
    else:
        judged = _by_join(urls, clean, size[2], size[3])
    return judged.select("page_id", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"))
