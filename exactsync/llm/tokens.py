"""Token counts by byte-pair merging with a heap and a linked list; no token identifiers are made.

Every text is cut at special strings and then into pre-tokens. The count of a pre-token is its number of
bytes minus the merges made: the lowest-rank adjacent pair is popped from a heap, its neighbours in the
linked list form new pairs, until no known pair is left (O(n log n) for a pre-token of n bytes).

Pre-tokens are cut by a pattern. Its classes of letters and numbers depend on the version of Unicode, so each character beyond ASCII is
probed once per worker: where the vocabulary's own cutter (of the ``tokenizers`` library, from the same file) classes it otherwise, that
cutter takes the chunk.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows and null ids are counted row by row; other
columns, whatever their names, are not read. Texts are processed whole, whatever their length.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

# Fixed pattern of the byte-level vocabulary: how its library cuts text before merging.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Entries of a generation of a cache: a bound on memory that never changes a count.
CACHE_ENTRIES = 300_000
_CACHED_CHARS = 64


_SPACE = regex.compile(r"\s")


class _Untidy(Exception):
    """A space followed by white space or nothing: the quick cut at spaces does not hold."""


class ChunkCache(dict):
    """Values of `` chunk`` (a space and what follows up to the next space), made by ``value`` on first use.

    Two generations: when the young one is full it becomes the old one, and what is used again moves back.
    """

    def __init__(self, value: Callable[[str], object], limit: int = CACHE_ENTRIES):
        super().__init__()
        self.value, self.limit, self.old = value, limit, {}

    def __missing__(self, chunk: str):
        made = self.old.get(chunk)
        if made is None:
            if not chunk or _SPACE.match(chunk):
                raise _Untidy
            made = self.value(" " + chunk)
            if len(chunk) > _CACHED_CHARS:
                return made
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[chunk] = made
        return made


class WordCache(dict):
    """Counts of pre-tokens; starts afresh when full."""

    def __init__(self, value: Callable[[str], int], limit: int = CACHE_ENTRIES):
        super().__init__()
        self.value, self.limit = value, limit

    def __missing__(self, word: str) -> int:
        made = self.value(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = made
        return made


_TIDY_CUT = regex.compile(r" (?=\S)")


def chunk_values(text: str, cache: ChunkCache) -> list:
    """Values of the chunks of a text. A pre-token always starts at a space that is followed by other
    than white space, so the chunks can be treated one by one."""
    chunks = text.split(" ")
    try:
        rest = list(map(cache.__getitem__, chunks[1:]))
    except _Untidy:
        chunks = _TIDY_CUT.split(text)
        rest = list(map(cache.__getitem__, chunks[1:]))
    return [cache.value(chunks[0]), *rest] if chunks[0] else rest


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, the other bytes, in order, for the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in printable}
    for n, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + n)
    return [names[b] for b in range(256)]


class _Agreement(dict):
    """Whether the pattern puts a character in the class in which a library's cutter sees it; probed on first use."""

    def __init__(self, pattern: regex.Pattern, cutter):
        super().__init__()
        self.pattern, self.cutter = pattern, cutter

    def __missing__(self, character: str) -> bool:
        same = True
        for before in "a1!":  # joined to a letter, a number or another sign, if it is of the same class
            pair = before + character
            ends = [end for _, (_, end) in self.cutter.pre_tokenize_str(pair)]
            same = same and ends == [m.end() for m in self.pattern.finditer(pair)]
        self[character] = same
        return same


class SpecialCut:
    """Finds the special strings of a vocabulary in a text; only plain ones are supported."""

    def __init__(self, added: list[dict]):
        for token in added:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"special token {token['content']!r} has options that are not supported")
        self.ids = {t["content"]: t["id"] for t in added}
        self.pattern = regex.compile("|".join(map(regex.escape, sorted(self.ids, key=len, reverse=True))))

    def parts(self, text: str) -> tuple[list[str], list[int]]:
        """The text around the special strings, and the ids of those."""
        if not any(s in text for s in self.ids):
            return [text], []
        return self.pattern.split(text), [self.ids[m[0]] for m in self.pattern.finditer(text)]


class MergeCounter:
    """Counts tokens with the merge ranks of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError(f"{path} is not a plain byte-level byte-pair vocabulary")
        if spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"{path} uses a normalizer or ignores merges")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        symbols = byte_symbols()
        number = {s: n for n, s in enumerate(symbols)}
        for left, right in pairs:
            number.setdefault(left + right, len(number))
        # Keyed by both symbols in one integer; the value holds the rank and, below it, the merged symbol.
        self.ranks = {
            number[left] << 32 | number[right]: rank << 32 | number[left + right]
            for rank, (left, right) in enumerate(pairs)
        }
        self.first = [number[s] for s in symbols]
        self.pattern = regex.compile(PRE_TOKEN)
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        self.agreed = _Agreement(self.pattern, self.cutter)
        self.special = SpecialCut(spec["added_tokens"])
        self.words = WordCache(self._count_word)
        self.chunks = ChunkCache(self._count_chunk)

    def count(self, text: str) -> int:
        parts, specials = self.special.parts(text)
        return len(specials) + sum(sum(chunk_values(p, self.chunks)) for p in parts)

    def _count_chunk(self, chunk: str) -> int:
        total = 0
        for word in self._cut(chunk):
            total += self.words[word] if len(word) <= _CACHED_CHARS else self._count_word(word)
        return total

    def _cut(self, chunk: str) -> list[str]:
        if chunk.isascii() or all(map(self.agreed.__getitem__, {c for c in chunk if c > "\x7f"})):
            return self.pattern.findall(chunk)
        return [chunk[start:end] for _, (start, end) in self.cutter.pre_tokenize_str(chunk)]

    def _count_word(self, word: str) -> int:
        return self.merged_length(word.encode("utf-8"))

    def merged_length(self, data: bytes) -> int:
        """Bytes minus merges of one pre-token."""
        ranks, size, low = self.ranks, len(data), 0xFFFFFFFF
        parts = [self.first[b] for b in data]
        heap = []
        for at in range(size - 1):
            found = ranks.get(parts[at] << 32 | parts[at + 1])
            if found is not None:
                heap.append((found >> 32) << 32 | at)
        if not heap:
            return size
        heapq.heapify(heap)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        left = size
        while heap:
            top = heapq.heappop(heap)
            at = top & low
            right = after[at]
            if parts[at] < 0 or right >= size:
                continue
            found = ranks.get(parts[at] << 32 | parts[right])
            if found is None or found >> 32 != top >> 32:
                continue  # one of the two has been merged meanwhile
            merged = parts[at] = found & low
            parts[right] = -1
            left -= 1
            after[at] = follow = after[right]
            if follow < size:
                before[follow] = at
                found = ranks.get(merged << 32 | parts[follow])
                if found is not None:
                    heapq.heappush(heap, (found >> 32) << 32 | at)
            ahead = before[at]
            if ahead >= 0:
                found = ranks.get(parts[ahead] << 32 | merged)
                if found is not None:
                    heapq.heappush(heap, (found >> 32) << 32 | ahead)
        return left


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """The counter of a vocabulary, read once per Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def count_tokens(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 1024
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row; one narrow stage.

    ``vocabulary`` is a path that every executor has (tokenizer files are part of their installation).
    """
    id_type = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([0 if t is None else len(t.encode("utf-8")) for t in texts], pa.int64()),
                    pa.array([tool.count(t) if t else 0 for t in texts], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(measure, schema).withColumn("over_limit", F.col("n_tokens") > limit)
