import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from exactsync.llm import divergence
from exactsync.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def slow(rows, least=3, top=200):
    """Rows of (text, lang, source)."""
    counts, seen, groups = Counter(), defaultdict(set), set()
    for n, (text, lang, source) in enumerate(rows):
        groups.add((lang or "", source or ""))
        for t in terms_of(text):
            counts[lang or "", source or "", t] += 1
            seen[lang or "", t].add(n)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (of, t), docs in seen.items() if of == lang and len(docs) >= least)
        sources = sorted(s for of, s in groups if of == lang)
        share = lambda n, total: 1 + 10**9 * (n + 1) // (total + len(kept))  # noqa: B023, E731
        totals = {s: sum(counts[lang, s, t] for t in kept) for s in sources}
        p = {(s, t): share(counts[lang, s, t], totals[s]) for s in sources for t in kept}
        q = {t: share(sum(counts[lang, s, t] for s in sources), sum(totals.values())) for t in kept}
        f = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pairs = [(o, sum(f(p[s, t], p[o, t]) for t in kept)) for o in sources if o != s]
            said = [(t, f(p[s, t], q[t])) for t in kept if counts[lang, s, t] and p[s, t] > q[t]]
            for part, items, stop in (("pair", pairs, None), ("term", said, top)):
                ranked = sorted(items, key=lambda r: (-r[1], r[0].encode()))[:stop]
                out += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(ranked)]
    return sorted(out)


def sample(rng):
    words = ["a", "B", "b", "abcdefgh", "abcdefghi", "ABCDEFGHI", "abcdefghabcdefgh", "abcdefghabcdefghx", "é", "É", "日本語", "日本", "x" * 50, "𝒳y", "z\x00z", "don't"]
    words += [f"w{chr(97 + i % 26)}{'q' * (i % 17)}" for i in range(60)]
    texts = [None, "", " 123 \n", "once", "\x7f@[`{", "É é é"]
    texts += [rng.choice((" ", "-", "\n", ", ")).join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    rows = [(t, rng.choice(("en", "en", "de", None)), rng.choice(("s0", "s0", "s0", "s1", "s2", None))) for t in texts]
    rows += [("alone here", "fr", "s0"), ("12", "it", "s1"), (None, "it", "s2")]
    return rows + rows[10:20]


@pytest.mark.parametrize("shard_bytes", [1, 2000, 1 << 25])
def test_audit_equals_brute_force(spark, docs, shard_bytes):
    rows = sample(random.Random(shard_bytes))
    table = docs([(n, *r) for n, r in enumerate(rows)]).withColumns({c: F.lit(1) for c in ("term", "n", "value", "rank", "item")})
    out = divergence.audit(table.repartition(4), shard_bytes=shard_bytes, held_counts=50, slice_rows=30, cells=20)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == slow(rows)


def test_few_terms_and_empty_tables(spark, docs):
    rows = sample(random.Random(7))
    out = divergence.audit(docs([(n, *r) for n, r in enumerate(rows)]), min_documents=5, top=4)
    assert sorted(map(tuple, out.collect())) == slow(rows, 5, 4)
    assert divergence.audit(docs([])).collect() == []


def test_large_counts_stay_exact(spark):
    n = 9_300_000_000_000_000
    share = divergence._share(F.col("n"), F.col("n") * 3, F.lit(7).cast("long"))
    got = spark.createDataFrame([(n,), (0,)], "n long").select(share.alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (n + 1) // (3 * n + 7), 1 + 10**9 // 7]


def test_pointers_are_sorted_by_slice_and_term():
    rng = random.Random(5)
    text = " ".join(rng.choice(("ab", "AB", "abcdefgh", "abcdefghi", "z", "é" * 9)) for _ in range(500)) + " abc"
    data, ends = divergence.text_buffer(pa.array(["skipped", text, None, ""]).slice(1))
    assert ends.tolist() == [len(text.encode()) + 1, len(text.encode()) + 2, len(text.encode()) + 3]
    starts, lengths = divergence.word_pointers(data)
    slices = np.array([rng.randint(0, 2) for _ in starts])
    lowered = np.append(divergence._LOWERED[data], np.zeros(8, np.uint8))
    order, runs = divergence.sorted_pointers(lowered, starts, lengths, slices)
    words = [t.encode() for t in terms_of(text)]
    keys = [(slices[n], words[n]) for n in order.tolist()]
    assert sorted(order.tolist()) == list(range(len(words))) and keys == sorted(keys)
    assert runs.tolist() == [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
    assert divergence._pieces(lowered, starts, lengths).to_pylist() == terms_of(text)


@pytest.mark.parametrize("name", ["op11_url_filter", "op13_source_divergence"])
def test_queries_equal_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf_dir), sf_dir, name, QUERIES[name], ORACLES[name]) is None
