"""Quality classifier: a generalised additive model with pairwise interactions (GA2M).

Features are shares and means over the whole text. Each is cut into quantile bins, and the model is one look-up table per feature
plus one per chosen pair of features. Training boosts cyclically: feature after feature, a shallow tree over the bins (three splits at most)
is fitted to the gradient of the log loss and added, shrunken, to that feature's table. The pairs whose
best four-quadrant tree explains most of what is left get tables of their own, boosted the same way. A score
is the logistic function of the sum of the bins' values, taken for a batch of texts at once.

The model is fitted on the driver from at most ``2 * sample`` labelled rows chosen by hash (a bounded sample of narrow feature rows); all rows are scored
in one narrow stage.

Defined cases: null and empty texts have all features zero and are scored like any other; labels that are null are not used and
several labels of a document are averaged; without usable labels every score is 0.5; a null id is never
learned from and not held out; repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.language import part_of

SAMPLE = 20_000
BINS = 32
ROUNDS = 150
RATE = 0.2
PAIRS = 8
PAIR_BINS = 8
PREDICT_AT = 0.3

# Classes of bytes; those of multi-byte characters are one class.
_CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "comma", "loud", "bar", "symbol", "quote", "wide", "other")
_CLASS = {name: n for n, name in enumerate(_CLASSES)}


def _byte_classes() -> np.ndarray:
    out = np.full(256, _CLASS["other"], np.uint8)
    for name, chars in (
        ("lower", "abcdefghijklmnopqrstuvwxyz"),
        ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("digit", "0123456789"),
        ("space", " \t\r\x0b\x0c"),
        ("line", "\n"),
        ("stop", ".;"),
        ("comma", ",:"),
        ("loud", "!?"),
        ("bar", "|<>{}[]\\/_="),
        ("symbol", "#$%&*@^~+"),
        ("quote", "\"'()-"),
    ):
        out[[ord(c) for c in chars]] = _CLASS[name]
    out[128:] = _CLASS["wide"]
    return out


_BYTE_CLASS = _byte_classes()
FEATURES = (
    "log_bytes",
    "log_words",
    "word_length",
    "words_per_line",
    "upper",
    "digit",
    "stop",
    "comma",
    "loud",
    "bar",
    "symbol",
    "quote",
    "wide",
    "other",
    "repeated_words",
    "repeated_lines",
    "loud_lines",
    "barred_lines",
    "symbol_words",
    "unended_lines",
)


def features(text: str | None) -> np.ndarray:
    """Feature values of a text, in the order of ``FEATURES``."""
    out = np.zeros(len(FEATURES))
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return out
    counts = np.bincount(_BYTE_CLASS[np.frombuffer(data, np.uint8)], minlength=len(_CLASSES))
    size, words, lines = len(data), data.split(), data.split(b"\n")
    many = max(1, len(words))
    share = lambda name: counts[_CLASS[name]] / size
    out[:4] = np.log1p(size), np.log1p(len(words)), sum(map(len, words)) / many, len(words) / len(lines)
    out[4] = counts[_CLASS["upper"]] / max(1, counts[_CLASS["upper"]] + counts[_CLASS["lower"]])
    for at, name in enumerate(("digit", "stop", "comma", "loud", "bar", "symbol", "quote", "wide", "other"), 5):
        out[at] = share(name)
    out[14] = 1 - len(set(words)) / many
    out[15] = 1 - len(set(lines)) / len(lines)
    out[16] = sum(line.isupper() for line in lines) / len(lines)
    out[17] = sum(b"|" in line for line in lines) / len(lines)
    out[18] = (counts[_CLASS["symbol"]] + counts[_CLASS["bar"]] + counts[_CLASS["loud"]]) / many
    out[19] = sum(not line.rstrip().endswith((b".", b"!", b"?")) for line in lines) / len(lines)
    return out


def _gain(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    return grad * grad / (hess + 1.0)


def _cut(grad: np.ndarray, hess: np.ndarray) -> tuple[float, int]:
    """Best single split of bins and its gain."""
    left_g, left_h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    if not len(left_g):
        return 0.0, 0
    total_g, total_h = grad.sum(), hess.sum()
    gains = _gain(left_g, left_h) + _gain(total_g - left_g, total_h - left_h) - _gain(total_g, total_h)
    at = int(gains.argmax())
    return float(gains[at]), at + 1


def shallow_tree(grad: np.ndarray, hess: np.ndarray, splits: int = 3) -> np.ndarray:
    """Value of every bin: the stretches of the best splits, each with its Newton step."""
    stretches = [(0, len(grad))]
    for _ in range(splits):
        cuts = [(*_cut(grad[a:b], hess[a:b]), a, b) for a, b in stretches]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        stretches.remove((a, b))
        stretches += [(a, a + at), (a + at, b)]
    out = np.zeros(len(grad))
    for a, b in stretches:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + 1.0)
    return out


def quadrants(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree on a pair of features: a split of the first, and one of the second on either side."""
    best, values = 0.0, np.zeros_like(grad)
    for at in range(1, len(grad)):
        total, new = 0.0, np.zeros_like(grad)
        for part in (slice(0, at), slice(at, None)):
            g, h = grad[part].sum(axis=0), hess[part].sum(axis=0)
            gain, cut = _cut(g, h)
            total += gain + float(_gain(g.sum(), h.sum()))
            for side in (slice(0, cut), slice(cut, None)):
                new[part, side] = g[side].sum() / (h[side].sum() + 1.0)
        if total > best:
            best, values = total, new
    return best, values


class Model:
    """Bin edges and tables; ``score`` adds the bins' values."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        count, width = rows.shape
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.usable = count > 0 and 0 < labels.sum() < count
        if not self.usable:
            return
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(rows[:, f], quantiles)) for f in range(width)]
        self.coarse = [e[np.unique(np.linspace(0, len(e) - 1, PAIR_BINS - 1).astype(int))] if len(e) else e for e in self.edges]
        bins, wide = self._bins(rows, self.edges), self._bins(rows, self.coarse)
        share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        total = np.full(count, self.base)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                chance = 1 / (1 + np.exp(-total))
                grad = np.bincount(bins[f], labels - chance, len(table))
                hess = np.bincount(bins[f], chance * (1 - chance), len(table))
                step = RATE * shallow_tree(grad, hess)
                table += step
                total += step[bins[f]]
        chance = 1 / (1 + np.exp(-total))
        shape = lambda a, b: (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)

        def spread(a: int, b: int, values: np.ndarray) -> np.ndarray:
            rows_of, columns_of = shape(a, b)
            return np.bincount(wide[a] * columns_of + wide[b], values, rows_of * columns_of).reshape(rows_of, columns_of)

        gains = []
        for a in range(width):
            for b in range(a + 1, width):
                gains.append((quadrants(spread(a, b, labels - chance), spread(a, b, chance * (1 - chance)))[0], a, b))
        self.pairs = [(a, b, np.zeros(shape(a, b))) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
        for _ in range(ROUNDS // 5):
            for a, b, table in self.pairs:
                chance = 1 / (1 + np.exp(-total))
                step = RATE * quadrants(spread(a, b, labels - chance), spread(a, b, chance * (1 - chance)))[1]
                table += step
                total += step[wide[a], wide[b]]

    @staticmethod
    def _bins(rows: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(edges)]

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.usable:
            return np.full(len(rows), 0.5)
        total = np.full(len(rows), self.base)
        for table, bins in zip(self.tables, self._bins(rows, self.edges), strict=True):
            total += table[bins]
        wide = self._bins(rows, self.coarse)
        for a, b, table in self.pairs:
            total += table[wide[a], wide[b]]
        return 1 / (1 + np.exp(-total))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    parts: int = 5,
    held: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """A model of the labelled documents that are not held out."""
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("double").alias("label"))
    known = known.where((part_of("doc_id", parts) != held) & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.avg("label").alias("label"))
    bound = int(min(1.0, sample / max(1, known.count())) * (1 << 40))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < bound).limit(2 * sample)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = T.StructType([T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("label", T.DoubleType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64())), batch.column("label")], schema.names)

    # At most 2 * sample rows of an id and a label, so the broadcast and what comes back are bounded.
    met = rows.join(F.broadcast(chosen), "doc_id").limit(4 * sample).select("text", "label")
    table = met.mapInArrow(measure, schema).toArrow()
    values = np.array(table.column("values").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    target = (table.column("label").to_numpy() >= 0.5).astype(np.float64)
    order = np.lexsort((target, *values.T))  # the same model whatever order the rows came in
    return Model(values[order], target[order])


def scored(
    docs: DataFrame,
    model: Model,
    parts: int = 5,
    held: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    predict_at: float = PREDICT_AT,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t) for t in batch.column("text").to_pylist()]
            scores = model.score(np.stack(values)) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], schema.names)

    held_out = F.coalesce(part_of("doc_id", parts) == held, F.lit(False)).alias("held_out")
    predicted = F.when(F.col("score") >= predict_at, 1).otherwise(0).cast("int").alias("predicted")
    return rows.mapInArrow(measure, schema).select("doc_id", held_out, "score", predicted)
