import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from exactsync.llm import simhash
from exactsync.llm.components import components


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=3):
    """Smallest label reachable by pairs within the radius; prints: label -> fingerprint."""
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in prints}


def test_masks_cover_every_pair():
    for positions in ((1 << 64) - 1, (1 << 13) - 1, 0xFFFF0000FF):
        places = [b for b in range(64) if positions >> b & 1]
        tables = simhash.masks(3, positions)
        assert len(tables) == 15
        for differing in itertools.combinations(places, 3):
            bits = sum(1 << b for b in differing)
            assert any(not bits & m for m in tables)


def test_spark_hash_is_the_hash(spark):
    text = "ça va bien"
    ours = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert ours % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


def test_documents_against_all_pairs(docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "one two"), (6, "É é x   Ab"), (6, "again")]
    for i in range(10, 130):
        base = [rng.choice(words) for _ in range(rng.choice((3, 30, 300)))]
        rows.append((i, " ".join(base)))
        if i % 3 == 0:
            base[rng.randrange(len(base))] = "changed"
            rows.append((i + 1000, "  ".join(base).upper()))
        if i % 10 == 0:
            rows.append((i + 2000, rows[-1][1]))
    rows.append((500, " ".join(rng.choice(words) for _ in range(70_000))))
    got = simhash.near_duplicates(docs(rows)).collect()
    assert sorted((r.doc_id, int(r.fingerprint, 16)) for r in got) == sorted((i, slow_print(t)) for i, t in rows)
    labels = {n: slow_print(t) for n, (_, t) in enumerate(rows)}
    roots = classes(labels)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[roots[n]] = min(least.get(roots[n], i), i)
    want = sorted((i, least[roots[n]]) for n, (i, _) in enumerate(rows))
    assert sorted((r.doc_id, r.component_id) for r in got) == want


@pytest.mark.parametrize("cell", [1, 300])
def test_dense_balls_are_cut_again_and_lose_no_link(spark, docs, cell):
    rng = random.Random(9)
    prints = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(500):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(0, 24), rng.randint(0, 3))))
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [(simhash._signed(p),) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "print long"), cell=cell)
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    linked = {r.node % (1 << 64): r.root for r in components(found).collect()}
    want = classes({p: p for p in prints})
    groups, ours = {}, {}
    for p in prints:
        groups.setdefault(want[p], set()).add(p)
        ours.setdefault(linked.get(p, ("alone", p)), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def test_null_ids_and_empty_table(docs):
    got = simhash.near_duplicates(docs([(None, "a b c d"), (None, "a b c d"), (3, "x y z"), (None, "x y z")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("3", "3"), ("None", "3"), ("None", "None"), ("None", "None")]
    assert simhash.near_duplicates(docs([])).collect() == []


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    names = list(range(300))
    rng.shuffle(names)
    chain = [(a, b) for a, b in itertools.pairwise(names[:200])] + [(a, b) for a, b in itertools.pairwise(names[200:])]
    got = dict(map(tuple, components(spark.createDataFrame([*chain, (7, 7), *chain[:9], (None, 3)], "a long, b long")).collect()))
    assert got == {n: min(part) for part in (names[:200], names[200:]) for n in part}
