import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from exactsync.llm import secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
RULES = [
    ("assign", ASSIGN, lambda m: len(m[2]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def base(text):
    found = []
    for n, (kind, pattern, good) in enumerate(RULES):
        found += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if good(m)]
    return ",".join(x[2] for x in sorted(found))


HEX = hashlib.sha1(b"x").hexdigest()
TEXTS = [
    None,
    "",
    "plain words only",
    f'password = "hunter2hunter2" and token:{HEX}',
    "🚀é PassWord:abc.def=ghi token = short secret=1234567 api_key='ABCDEFGH'",
    "token=api_key:longvalue123 apikey == x TOKEN=token=abcdefgh",
    f"AKIA{'A' * 12} AKIAAKIA{'B' * 8} AKIA123 xAKIA{'Z9' * 9}",
    f"{HEX}{HEX} {HEX[:31]} g{HEX[:32]}g",
    "secret: 'aaaaaaaa' secret=\"bbbbbbbb" + "\n" + "key" * 30,
    ("word " * 500 + f"token={HEX} ") * 20,
]


@pytest.fixture
def scanned(docs):
    rows = list(enumerate(TEXTS)) + [(1, TEXTS[3]), (None, TEXTS[3])]
    found = secrets.scan(docs(rows)).select(
        "doc_id", secrets.joined(F.col("base")).alias("base"), secrets.joined(F.col("added")).alias("added")
    )
    return rows, found.collect()


def test_base_spans_equal_python(scanned):
    rows, found = scanned
    assert sorted((str(r.doc_id), r.base) for r in found) == sorted((str(i), base(t)) for i, t in rows)


def test_random_base_text(docs):
    rng = random.Random(7)
    parts = ["token", "api_key", "=", ":", " ", "'", '"', "AKIA", "ABCDEF", "0123456789abcdef" * 2, "x", "Q9", ".", "\n", "é"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    found = secrets.scan(docs(rows), ratios=[0.0] * 67 * 67).select("doc_id", secrets.joined(F.col("base")).alias("b"))
    assert dict(map(tuple, found.collect())) == {i: base(t) for i, t in rows}


def test_model_finds_random_tokens_and_leaves_words(docs, spark):
    rng = random.Random(3)
    words = ["configuration", "the", "of", "information", "handler", "value", "reader", "organisation", "stream"]
    prose = [(i, " ".join(rng.choice(words) for _ in range(200)) + " configuration_reader_value_2 internationalization9ofvalues") for i in range(60)]
    chars = secrets.ALPHABET[:62]
    planted = ["".join(rng.choice(chars) for _ in range(36)) + "7q" for _ in range(20)]
    rows = prose + [(100 + i, f"see {p} here") for i, p in enumerate(planted)]
    found = dict(
        map(tuple, secrets.scan(docs(rows)).select("doc_id", secrets.joined(F.col("added"))).collect())
    )
    assert all(found[i] == "" for i, _ in prose)
    assert sum(found[100 + i] == f"model:4:{4 + len(p)}" for i, p in enumerate(planted)) >= 18


def test_empty_table(docs):
    assert secrets.scan(docs([])).collect() == []


TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


def model_spans(text, ratios, threshold):
    """Spans of the model by plain Python."""
    spans = []
    for n, (_, pattern, good) in enumerate(RULES):
        spans += [(m.start(), m.end()) for m in pattern.finditer(text) if good(m)]
    out = []
    for m in TOKEN.finditer(text):
        codes = [secrets.ALPHABET.index(c) for c in m[0]]
        mean = sum(round(ratios[a * 67 + b], 4) for a, b in zip(codes, codes[1:], strict=False)) / (len(codes) - 1)
        free = not any(a < m.end() and b > m.start() for a, b in spans)
        if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and free and mean >= threshold:
            out.append(f"model:{m.start()}:{m.end()}")
    return ",".join(out)


def test_model_spans_equal_a_plain_ratio(docs):
    rng = random.Random(11)
    ratios = [rng.uniform(-1, 1) for _ in range(67 * 67)]
    parts = ["a1", "Zq", "0f" * 10, "xyz", " ", " ", "é", "/+", "token=", HEX, "AKIA" + "B" * 12, "_9"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 80)))) for i in range(200)]
    found = secrets.scan(docs(rows), ratios=ratios, threshold=0.05).select("doc_id", secrets.joined(F.col("added")).alias("a"))
    got = dict(map(tuple, found.collect()))
    assert got == {i: model_spans(t, ratios, 0.05) for i, t in rows} and sum(map(bool, got.values())) > 20


def test_long_tokens_and_many_spans_end_soon(docs):
    import time

    rng = random.Random(12)
    long = "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(1 << 18))
    many = " ".join(hashlib.md5(str(n).encode()).hexdigest() for n in range(8_000))
    start = time.time()
    table = docs([(1, long), (2, many), (3, "some words")])
    found = {r.doc_id: r for r in secrets.scan(table, threshold=-100.0).collect()}
    assert time.time() - start < 120
    assert [tuple(x) for x in found[1].added] == [(0, 3, 1 << 18)]
    assert [tuple(x) for x in found[2].base] == [(33 * n, 2, 33 * n + 32) for n in range(8_000)] and found[2].added == []


def test_values_and_pairs(spark):
    row = spark.createDataFrame([("ab=9 é",)], "t string").select(secrets._pairs(F.col("t")).alias("p")).first()
    code = secrets.ALPHABET.index
    pair = lambda x, y: code(x) * 67 + code(y)
    assert row.p == [pair("a", "b"), pair("b", "="), pair("=", "9"), None, None]


def test_training_counts_every_document(docs, spark):
    """Ordinary tokens and base values of all documents, whatever the sample of made-up strings."""
    rng = random.Random(13)
    words = ["alpha_beta", "x9", "path/to", "Q-q", "a" * 30, "9z" * 15]
    rows = [(n, " ".join(rng.choice(words) for _ in range(20)) + f" token={rng.choice(['Zz9Zz9Zz9', 'abcdefgh'])}!") for n in range(300)]
    rows += [(None, rows[0][1]), (5, None), (5, rows[1][1])]
    counts = {"value": {}, "word": {}, "sum": {}}

    def add(kind, token):
        codes = [secrets.ALPHABET.index(c) for c in token]
        for a, b in zip(codes, codes[1:], strict=False):
            counts[kind][a * 67 + b] = counts[kind].get(a * 67 + b, 0) + 1

    for _, text in rows:
        found = ASSIGN.search(text or "")
        if found:
            add("value", re.search("[A-Za-z0-9+/_=-]+$", found[0])[0])
            for t in re.findall("[A-Za-z0-9+/_=-]{2,}", text[: found.start()]):
                if not (len(t) >= 20 and re.search("[0-9]", t)):
                    add("word", t)
    value, made, word = (secrets._probabilities(counts[k]) for k in ("value", "sum", "word"))
    # With no sample the made-up strings have no counts.
    got = secrets.train(docs(rows), sample=0)
    want = [secrets.math.log((v + m) / 2 / w) for v, m, w in zip(value, made, word, strict=True)]
    assert got == pytest.approx(want)
