"""Secret scan with DataFrame functions only: fixed patterns, and character Markov models for the rest.

The base patterns give spans of three kinds. Two first-order Markov models over the characters of tokens
are trained: random strings (half of it the values the base patterns matched in all documents, half base64 text of
SHA-256 sums made from the ids of about 2,000 documents, so that every letter is known) and ordinary identifiers
(the tokens of all documents outside base spans). Equal tokens are counted before they are cut into characters, so that work
follows the vocabulary. A long token outside base spans is a
secret if its mean log-likelihood ratio per transition reaches ``threshold``. The models are two tables of
alphabet-squared counts; scoring is one narrow stage.

Defined cases: a null text is empty and has no spans; every row is scanned by itself, so repeated rows and null ids change nothing;
an empty table gives no rows and models of uniform counts; other columns are not read. Texts are
scanned whole. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds, in the order in which equal starts are listed. A failing match still uses up its text.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# Quick tests for "has a match that counts": a maximal run is long enough exactly if a part of it is.
_HAS = {"access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}", "assign": ASSIGN}
# Runs in which a match cannot begin inside the remains of a failing one, so the length can be in the pattern.
_LONG = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
KINDS = ("assign", "access", "hex", "model")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(ALPHABET)
_TOKEN = r"[A-Za-z0-9+/_=-]"
MIN_TOKEN = 20
THRESHOLD = 0.7
SAMPLE_DOCUMENTS = 2000
_SUMS = 8
_BLOCK = 256
_NO_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed a single time: Spark computes it again wherever a lambda mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array in blocks of ``_BLOCK``: work that copies an array at each step then copies a block, not all of it."""

    def cut(whole: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.ceil(F.size(whole) / _BLOCK).cast("int") - 1)
        some = F.transform(numbers, lambda n: F.slice(whole, n * _BLOCK + 1, F.lit(_BLOCK)))
        return F.when(F.size(whole) > 0, some).otherwise(F.slice(F.array(whole), F.lit(1), F.lit(0)))

    return _once(items, cut)


def _starts(text: Column, pattern: str) -> Column:
    """``array<struct<start, end>>`` of all matches: lengths of what lies between them and of the matches, added up by blocks."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length)
    steps = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"), sizes.alias("size"))

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + step["size"]
        return F.struct(
            end.alias("at"),
            F.concat(done["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("spans"),
        )

    def from_start(at: Column) -> Column:
        return F.struct(at.alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def located(blocks: Column) -> Column:
        lengths = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, step: n + step["gap"] + step["size"]))
        before = F.aggregate(
            lengths,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda done, n: F.struct((done["at"] + n).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts")),
        )["starts"]
        return F.flatten(F.zip_with(blocks, before, lambda b, at: F.aggregate(b, from_start(at), add)["spans"]))

    return _once(_blocks(steps), located)


def _with_kind(spans: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), number.alias("kind"), s["end"].alias("end"))
    )


def base_spans(text: Column) -> Column:
    """``array<struct<start, kind, end>>`` of the base patterns, by start and then kind."""
    none = F.array().cast(_NO_SPANS)
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assigned = F.transform(
        F.filter(
            F.arrays_zip(_starts(text, ASSIGN).alias("span"), values.alias("value")),
            lambda x: F.char_length(x["value"]) >= 8,
        ),
        lambda x: x["span"],
    )
    mark = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    found = [F.when(mark & text.rlike(_HAS["assign"]), _with_kind(assigned, "assign")).otherwise(none)]
    guards = {"access": F.contains(text, F.lit("AKIA")), "hex": F.lit(True)}
    for kind, pattern in _LONG.items():
        has = guards[kind] & text.rlike(_HAS[kind])
        found.append(F.when(has, _with_kind(_starts(text, pattern), kind)).otherwise(none))
    return F.array_sort(F.concat(*found))


def _values(text: Column) -> Column:
    """What the base spans hold, each up to its last separator; taken from the matches, not by place, so a text is read once a kind."""
    matches = lambda pattern, group=0: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    assigned = F.transform(
        F.filter(
            F.arrays_zip(matches(ASSIGN).alias("whole"), matches(ASSIGN, 2).alias("value")),
            lambda x: F.char_length(x["value"]) >= 8,
        ),
        lambda x: x["whole"],
    )
    none = F.array().cast("array<string>")
    mark = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    found = [F.when(mark & text.rlike(_HAS["assign"]), assigned).otherwise(none)]
    guards = {"access": F.contains(text, F.lit("AKIA")), "hex": F.lit(True)}
    found += [F.when(guards[k] & text.rlike(_HAS[k]), matches(p)).otherwise(none) for k, p in _LONG.items()]
    return F.transform(F.concat(*found), lambda v: F.regexp_extract(v, _TOKEN + "+$", 0))


def _pairs(token: Column) -> Column:
    """Numbers of the pairs of neighbouring characters, null where one is not in the alphabet; a token is cut up once."""
    codes = F.transform(F.split(token, ""), lambda c: F.when(c != "", F.instr(F.lit(ALPHABET), c) - 1).otherwise(-1))
    codes = F.filter(codes, lambda c: c.isNotNull())
    number = lambda a, b: F.when((a >= 0) & (b >= 0), a * _SIZE + b)
    count = F.char_length(token) - 1
    return _once(codes, lambda c: F.zip_with(F.slice(c, F.lit(1), count), F.slice(c, F.lit(2), count), number))


def _transitions(tokens: DataFrame) -> DataFrame:
    """Counts of neighbouring characters (``pair`` is the number of the pair) in the column ``token``; equal tokens are cut up once."""
    counted = tokens.where(F.char_length("token") >= 2).groupBy("token").agg(F.count("*").alias("n"))
    pairs = counted.select(F.explode(_pairs(F.col("token"))).alias("pair"), "n")
    return pairs.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))


def _probabilities(counts: dict[int, int]) -> list[float]:
    """Probability of each character after each, with one added to every count."""
    out = []
    for a in range(_SIZE):
        row = [counts.get(a * _SIZE + b, 0) + 1 for b in range(_SIZE)]
        total = sum(row)
        out += [n / total for n in row]
    return out


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE_DOCUMENTS) -> list[float]:
    """Log-likelihood ratios (random to ordinary) of all pairs of characters: alphabet-squared numbers.

    Base values and ordinary tokens of all documents are counted. The ids of about ``sample`` documents, chosen by hash, give the
    made-up random strings. The random model is the mean of the two kinds of random strings, however many there are of each.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("string").alias("id"), text.alias("text"))
    total = max(1, docs.select(F.lit(1)).count())
    bound = F.lit(int(min(1.0, sample / total) * 2**62))
    some = rows.select("id").where(F.pmod(F.xxhash64("id"), F.lit(2**62)) < bound)
    values = rows.select(F.explode(_values(F.col("text"))).alias("token"))
    salted = some.select(F.explode(F.sequence(F.lit(1), F.lit(_SUMS))).alias("salt"), "id")
    sums = salted.select(F.base64(F.unhex(F.sha2(F.concat_ws(":", "salt", "id"), 256))).alias("token"))
    base = r"(?i:(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\S*)|AKIA[A-Z0-9]+|[0-9a-f]{32,}"
    words = rows.select(F.regexp_replace("text", base, " ").alias("text")).select(
        F.explode(F.regexp_extract_all("text", F.lit(_TOKEN + "{2,}"), F.lit(0))).alias("token")
    )
    words = words.where(~(F.col("token").rlike("[0-9]") & (F.char_length("token") >= MIN_TOKEN)))  # unlabelled
    tokens = {"value": values, "sum": sums, "word": words}
    parts = [_transitions(found).withColumn("model", F.lit(name)) for name, found in tokens.items()]
    counts: dict[str, dict[int, int]] = {name: {} for name in tokens}
    for row in parts[0].unionByName(parts[1]).unionByName(parts[2]).collect():  # three tables of at most alphabet-squared rows
        counts[row["model"]][row["pair"]] = row["n"]
    value, made, word = (_probabilities(counts[name]) for name in tokens)
    return [math.log((v + m) / 2 / w) for v, m, w in zip(value, made, word, strict=True)]


def _mean_ratio(token: Column, ratios: list[float]) -> Column:
    table = F.split(F.lit(" ".join(f"{r:.4f}" for r in ratios)), " ").cast("array<double>")

    total = F.aggregate(_pairs(token), F.lit(0.0), lambda done, pair: done + F.get(table, pair))
    return total / (F.char_length(token) - 1)


def model_spans(text: Column, base: Column, ratios: list[float], threshold: float = THRESHOLD) -> Column:
    """Spans of long tokens with a digit and a letter that look random and touch no base span."""
    run = rf"(?<!{_TOKEN}){_TOKEN}{{{MIN_TOKEN},}}"
    tokens = F.regexp_extract_all(text, F.lit(run), F.lit(0))
    pairs = F.arrays_zip(_starts(text, run).alias("span"), tokens.alias("token"))
    # Base spans by blocks with their first start and last end, so a token is compared with few of them.
    near = F.transform(
        _blocks(base),
        lambda b: F.struct(
            b[0]["start"].alias("start"), F.array_max(F.transform(b, lambda s: s["end"])).alias("end"), b.alias("spans")
        ),
    )

    def meets(spans: Column, span: Column, inside=None) -> Column:
        def touches(s: Column) -> Column:
            hit = (s["start"] < span["end"]) & (s["end"] > span["start"])
            return hit if inside is None else F.when(hit, inside(s)).otherwise(False)

        return F.exists(spans, touches)

    random = _once(
        near,
        lambda blocks: F.filter(
            pairs,
            lambda x: x["token"].rlike("[0-9]")
            & x["token"].rlike("[A-Za-z]")
            & ~meets(blocks, x["span"], lambda block: meets(block["spans"], x["span"]))
            & (_mean_ratio(x["token"], ratios) >= threshold),
        ),
    )
    spans = _with_kind(F.transform(random, lambda x: x["span"]), "model")
    return F.when(text.rlike(run), spans).otherwise(F.array().cast(_NO_SPANS))


def scan(
    docs: DataFrame,
    ratios: list[float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``base`` and ``added`` (``array<struct<start, kind, end>>``, kind an index of ``KINDS``) of every row."""
    if ratios is None:
        ratios = train(docs, id_column, text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    based = rows.withColumn("base", base_spans(F.col("text")))
    return based.select(
        "doc_id", "base", model_spans(F.col("text"), F.col("base"), ratios, threshold).alias("added")
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined in their order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
