"""Language identification by cross-parsing: the language that needs the fewest phrases to spell a text wins.

For each language a suffix automaton of labelled text is built. A text is parsed from left to right into longest
phrases that occur in that text; the count, times the bits that point into the training text, divided by the length, is
the cross-parsing entropy. Training text is a bounded sample (``pieces`` documents with a letter per language, one per hash bucket, a
stretch of ``piece_chars`` code points from a hashed place in each); only it travels, every Python worker builds the automata once.

Every letter of the training text has a symbol of its own, however many there are. Transitions by the commonest letters
stand in a dense table, those by all others in one sorted list of (state, symbol); both grow with the learned text only.

Texts are parsed whole. They are cut into segments of 256 symbols, all of a batch are parsed side by side for all languages with one
look-up per symbol, and a cut costs every language the same one phrase. Letters are lowered; whatever is
no letter becomes one space.

Defined cases: ``und`` with score 0 for a null text, one without any letter, or if nothing was learned; equal counts go to the smaller
language name; a document with a null id is never learned from and not held out; repeated rows are predicted each;
other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.shared import staged

PIECES = 64
PIECE_CHARS = 640
#: Code points learned in all; with many languages each gets less, so the tables of a worker stay bounded.
LEARNED_CHARS = 400_000
#: Width of the dense table; symbols from here on are looked up in the sorted list.
SYMBOLS = 64
SEGMENT = 256
UNKNOWN = "und"
_SPACE, _OTHER, _BREAK, _FIRST = 0, 1, 2, 3
_KEY_BITS = 21  # a symbol fits: there are fewer letters than code points


def part_of(column: str, parts: int) -> Column:
    """crc32 of the value's text modulo ``parts`` (null for null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


def learned_text(docs: DataFrame, pieces: int, piece_chars: int) -> dict[str, list[str]]:
    """Stretches of labelled text per language; ``docs`` has ``doc_id``, ``text`` and ``lang`` of the documents to learn from.

    The least hash in each of ``pieces`` buckets is a map-side combined minimum, whatever a language's share.
    """
    labelled = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    known = labelled.withColumn("hash", F.xxhash64("doc_id"))
    bucket = F.pmod("hash", F.lit(pieces)).alias("bucket")
    chosen = staged(known.groupBy("lang", bucket).agg(F.min("hash").alias("hash")).select("lang", "hash"), "pieces")
    languages = chosen.select("lang").distinct().count()
    chars = max(16, min(piece_chars, LEARNED_CHARS // max(1, languages * pieces)))
    met = known.join(chosen, ["lang", "hash"])
    begin = F.pmod("hash", F.greatest(F.lit(1), F.char_length("text") - chars + 1)) + 1
    piece = F.substr("text", begin.cast("int"), F.lit(chars))
    found = met.groupBy("lang", "hash").agg(F.min(piece).alias("piece"))  # one of rows that repeat an id
    out: dict[str, list[str]] = {}
    for lang, piece in sorted((r["lang"], r["piece"]) for r in found.collect()):  # ``pieces`` rows per language
        out.setdefault(lang, []).append(piece)
    return out


class Alphabet:
    """Symbol of every code point: a space for what is no letter, one for each learned letter, commonest first, one for all others."""

    def __init__(self, texts: list[str]):
        letters = Counter(c for t in texts for c in t.lower() if c.isalpha()).most_common()
        names = {c: _FIRST + n for n, (c, _) in enumerate(letters)}
        self.table = np.zeros(0x110000, np.int32)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                self.table[point] = names.get(c.lower(), _OTHER)

    def symbols(self, text: str) -> np.ndarray:
        codes = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = codes == _SPACE
        again = np.append(False, blank[1:] & blank[:-1])
        return codes[~again] if len(codes) else codes


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton: the paths from state 0 spell exactly the substrings."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            goal = moves[state][symbol]
            if length[goal] == length[state] + 1:
                link[new] = goal
            else:
                twin = len(moves)
                moves.append(dict(moves[goal]))
                length.append(length[state] + 1)
                link.append(link[goal])
                while state >= 0 and moves[state].get(symbol) == goal:
                    moves[state][symbol] = twin
                    state = link[state]
                link[goal] = link[new] = twin
        last = new
    return moves


class Parser:
    """Phrase counts of texts against all languages."""

    def __init__(self, texts: dict[str, list[str]], segment: int = SEGMENT, width: int = SYMBOLS):
        self.languages, self.segment, self.width = sorted(texts), segment, width
        self.alphabet = Alphabet([p for lang in self.languages for p in texts[lang]])
        roots, starts, parts, bits = [], [], [], []
        keys: list[int] = []
        goals: list[int] = []
        base = 0
        for lang in self.languages:
            learned: list[int] = []
            for piece in texts[lang]:
                learned += [*self.alphabet.symbols(piece).tolist(), _BREAK]
            moves = automaton(learned)
            dead = base + len(moves) * width  # before the first symbol and after an unknown one: the next begins a phrase
            root = np.full(width, dead, np.int64)
            for symbol, goal in moves[0].items():
                if symbol < width:
                    root[symbol] = base + goal * width
            root[[_OTHER, _BREAK]] = dead
            table = np.tile(root << 1 | 1, (len(moves) + 1, 1))  # no move: a new phrase begins with this symbol
            for state, found in enumerate(moves):
                for symbol, goal in found.items():
                    if symbol < width:
                        table[state, symbol] = (base + goal * width) << 1
                    else:
                        keys.append((base + state * width) << _KEY_BITS | symbol)
                        goals.append(base + goal * width)
            table[:, [_OTHER, _BREAK]] = dead << 1 | 1  # letters never learned are phrases of their own
            roots.append(base)
            starts.append(dead)
            parts.append(table.astype(np.int32).ravel())
            bits.append(math.log2(max(2, len(learned))))
            base += table.size
        self.table = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.roots, self.starts, self.bits = np.array(roots, np.int64), np.array(starts, np.int32), np.array(bits)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.goals = np.append(np.array(goals, np.int64)[order], 0)

    def _listed(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the sorted list has a transition from each state by each symbol, and where to."""
        keys = states.astype(np.int64) << _KEY_BITS | symbols
        at = np.searchsorted(self.keys, keys)
        return self.keys[at] == keys, self.goals[at]

    def _wide_moves(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Moves (languages by texts) by symbols beyond the dense table."""
        known, goal = self._listed(states, symbols)
        first, begin = self._listed(np.repeat(self.roots[:, None], len(symbols), axis=1), symbols)
        begun = np.where(first, begin, self.starts[:, None]) << 1 | 1
        return np.where(known, goal << 1, begun).astype(np.int32)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases (texts by languages) and the number of symbols of each text."""
        codes = [self.alphabet.symbols(t) for t in texts]
        sizes = np.array([len(c) for c in codes], np.int64)
        counts = -(-sizes // self.segment)
        offsets = np.append(0, np.cumsum(counts))
        grid = np.zeros((int(offsets[-1]), self.segment), np.int32)
        flat = grid.reshape(-1)
        for c, at in zip(codes, offsets[:-1].tolist(), strict=True):
            flat[at * self.segment : at * self.segment + len(c)] = c
        lengths = np.full(len(grid), self.segment, np.int64)
        lengths[offsets[1:][counts > 0] - 1] = (sizes - (counts - 1) * self.segment)[counts > 0]
        order = np.argsort(-lengths, kind="stable")
        columns = np.ascontiguousarray(grid[order].T)
        beyond = columns >= self.width
        dense = np.where(beyond, _OTHER, columns)
        wide = beyond.any(axis=1)
        active = len(grid) - np.searchsorted(np.sort(lengths), np.arange(self.segment), side="right")
        total = np.zeros((len(self.languages), len(grid)), np.int32)
        state = np.repeat(self.starts[:, None], len(grid), axis=1)
        for at in range(self.segment):
            n = int(active[at])
            if not n:
                break
            move = self.table.take(state[:, :n] + dense[at, :n])
            if wide[at]:
                some = np.flatnonzero(beyond[at, :n])
                move[:, some] = self._wide_moves(state[:, some], columns[at, some])
            total[:, :n] += move & 1
            state[:, :n] = move >> 1
        by_segment = np.empty_like(total)
        by_segment[:, order] = total
        sums = np.append(np.zeros((len(total), 1), np.int64), np.cumsum(by_segment, axis=1, dtype=np.int64), axis=1)
        return (sums[:, offsets[1:]] - sums[:, offsets[:-1]]).T, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and margin to the next one (0 to 1) of each text."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [n for n, t in enumerate(texts) if t and self.languages and any(map(str.isalpha, t))]
        step = 1 << 21
        while at:
            # About two million code points at a time; a longer text stands alone.
            room = np.cumsum([len(texts[n]) for n in at])
            cut = max(1, int(np.searchsorted(room, step, side="right")))
            now, at = at[:cut], at[cut:]
            phrases, sizes = self.phrases([texts[n] for n in now])
            entropy = phrases * self.bits / sizes[:, None]
            best = entropy.argmin(axis=1)
            ranked = np.sort(entropy, axis=1)
            margin = 1 - ranked[:, 0] / ranked[:, 1] if len(self.languages) > 1 else np.ones(len(now))
            for n, b, m in zip(now, best.tolist(), margin.tolist(), strict=True):
                names[n], scores[n] = self.languages[b], m
        return names, scores


_PARSERS: dict[int, Parser] = {}


def parser(texts: dict[str, list[str]]) -> Parser:
    """The parser of some training text, built once per Python worker (one is kept)."""
    key = hash(tuple((lang, *parts) for lang, parts in sorted(texts.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(texts)
    return _PARSERS[key]


def predicted(docs: DataFrame, texts: dict[str, list[str]]) -> DataFrame:
    """``docs`` (with a column ``text``) plus ``lang_pred`` and ``score``; one narrow stage."""
    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *extra])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = parser(texts)
        for batch in batches:
            names, scores = tool.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names
            )

    return docs.mapInArrow(predict, schema)


def learn(
    docs: DataFrame,
    pieces: int = PIECES,
    piece_chars: int = PIECE_CHARS,
    parts: int = 4,
    held: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> dict[str, list[str]]:
    """Training text of the documents that are not held out."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    )
    return learned_text(rows.where(part_of("doc_id", parts) != held), pieces, piece_chars)


def identify(docs: DataFrame, parts: int = 4, held: int = 2, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row, learned from the rows that are not held out."""
    texts = learn(docs, parts=parts, held=held, id_column=id_column, text_column=text_column, **options)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    held_out = F.coalesce(part_of("doc_id", parts) == held, F.lit(False)).alias("held_out")
    return predicted(rows, texts).select("doc_id", held_out, "lang_pred", "score")
