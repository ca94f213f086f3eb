import hashlib
import random
import zlib

from pyspark.sql import functions as F

from exactsync.llm import periodic
from exactsync.llm.queries import QUERIES, repeat_words


def slow_runs(words, least_words=6, least_periods=4):
    """Every stretch with a period, found by comparing all words; the smallest period of a stretch counts."""
    found, n = {}, len(words)
    for period in range(1, n // 2 + 1):
        at = 0
        while at < n:
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(least_words, least_periods * period):
                found.setdefault((at, length), period)
            at = max(end, at + 1)
    return sorted(((a, length, p) for (a, length), p in found.items()), key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text, rewritten):
    words = (text or "").encode().split()
    hashed = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if rewritten and hashed is not None and hashed % 10 == 0 and words:
        g, n = hashed // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    gone = {i for a, length, p in runs for i in range(a + p, a + length)}
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def documents(rng, count):
    out = []
    for _ in range(count):
        n = rng.randint(0, 60)
        words = [rng.choice(rng.choice(("a", "ab", "abc", "abcdefghijk"))) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 10)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        out.append(words)
    return out


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        chunk = [[w.encode() for w in d] for d in documents(rng, rng.randint(1, 5))]
        for words, periods in ((6, 4), (2, 2), (3, 3)):
            want = [slow_runs(d, words, periods) for d in chunk]
            assert periodic.runs_by_document(chunk, least_words=words, least_periods=periods) == want


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for size in (1, 2, 5, 40, 300):
        symbols = periodic.np.array([rng.randint(0, 3) for _ in range(size)])
        listed = symbols.tolist()
        want = sorted(range(size), key=lambda i: listed[i:])
        order = periodic.suffix_array(symbols)
        assert order.tolist() == want
        inverse = periodic.np.empty(size, int)
        inverse[order] = periodic.np.arange(size)
        lcp = periodic.common_prefixes(symbols, order, inverse)
        for k in range(1, size):
            a, b = listed[want[k - 1] :], listed[want[k] :]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_long_texts_of_one_word_and_of_none():
    assert periodic.runs_by_document([[b"w"] * 100_000, [], [b"x", b"y"] * 4]) == [[(0, 100_000, 1)], [], [(0, 8, 2)]]


def test_scan(spark, docs):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "one", "a a a a a", "A a a a a a a", "a\x0ba\x0ca\ra a a a a", "é é é é é é ñ", "x y " * 30]
    texts += [" ".join(d) for d in documents(rng, 150)] + ["w " * 30_000 + " ".join(f"v{i}" for i in range(20_000))]
    rows = list(enumerate(texts)) + [(5, texts[5]), (5, "b b b b b b b"), (None, "c " * 8)]
    table = docs(rows).withColumns({c: F.lit(1) for c in ("n_runs", "start", "length", "period")}).repartition(5)
    quick = [r for r in rows if r[1] is None or len(r[1]) < 50_000]
    for rewrite in (None, repeat_words):
        out = periodic.scan(table, rewrite)
        assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        got = sorted(map(tuple, out.collect()), key=str)
        want = sorted((slow_row(*r, rewrite is not None) for r in quick), key=str)
        assert [r for r in got if r[0] != len(texts) - 1] == [r for r in want if r[0] != len(texts) - 1]
        assert len(got) == len(rows)
    more = {r.doc_id: r for r in periodic.scan(table, with_runs=True).collect()}
    assert [tuple(r) for r in more[8].runs] == [(0, 60, 2)] and more[8].collapsed == "x y"
    assert more[len(texts) - 1].collapsed.startswith("w v0 v1") and more[0].runs == [] and more[0].collapsed == ""
    assert periodic.scan(docs([])).collect() == []


def test_query_over_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, sf_dir).collect()))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    some = [tuple(r) for r in rows if len(r.text or "") < 6000]
    want = {r[0]: r for r in (slow_row(*x, True) for x in some)}
    assert len(got) == len(rows) and all(want.get(r[0], r) == r for r in got) and any(r[1] for r in got)
