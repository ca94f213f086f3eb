import itertools
import random
from fractions import Fraction

import corpus_pipeline
from exactsync.llm import nearcopies


def words_of(text):
    return (text or "").encode().lower().split()


def slow_set(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_by_force(texts):
    """First place of each class of all pairs of similarity 0.8 or more."""
    numbers: dict = {}
    sets = [{numbers.setdefault(s, len(numbers)) for s in slow_set(t)} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        union = len(sets[a]) + len(sets[b]) - common
        if not union or Fraction(common, union) >= Fraction(4, 5):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [n for n in range(len(texts)) if find(n) == n]


def altered(rng, words, places):
    out = list(words)
    for at in rng.sample(range(len(words)), places):
        out[at] = f"x{rng.random()}"
    return " ".join(out)


def sample():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "One", "a b c d", "a b c e", "1 2 3 4 5 6 7 8", "1 2 3 4 5 6 7 8 9", "1 2 3 4 5 6 7 9"]
    for _ in range(60):  # similarities on both sides of 0.8
        base = [rng.choice(vocabulary) for _ in range(rng.choice((30, 100, 300)))]
        texts += [" ".join(base), altered(rng, base, max(1, len(base) // rng.choice((20, 40, 50, 60)))), " ".join(base).upper()]
    centre = [rng.choice(vocabulary) for _ in range(200)]
    texts += [altered(rng, centre, rng.randint(1, 6)) for _ in range(80)]  # a large group, not all of its pairs similar
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(60)) + " " + passage for _ in range(40)]
    rng.shuffle(texts)
    return texts


def test_firsts_equal_brute_force(spark, docs):
    texts = sample()
    rows = docs(list(enumerate(texts))).repartition(7)
    got = sorted(r.doc for r in nearcopies.firsts(rows, "doc_id").collect())
    assert got == kept_by_force(texts)
    assert nearcopies.firsts(docs([]), "doc_id").collect() == []


def test_stage_keeps_one_of_copies_that_differ_in_many_bits(spark, docs):
    texts = sample()
    numbered = docs(list(enumerate(texts))).select("doc_id", "text", "lang", "source", "n_chars").coalesce(1)
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    assert sorted(r.doc_id for r in stage(spark, numbered, "").collect()) == kept_by_force(texts)


def unlike(rng, members, words, places):
    """Altered copies of one text, most of whose pairs are less similar than 0.8."""
    centre = [f"v{rng.randint(0, 5000)}" for _ in range(words)]
    return [altered(rng, centre, places if n % 4 else rng.randint(1, places)) for n in range(members)]


def test_large_buckets_are_dealt_in_blocks_and_cut_again(spark, docs):
    rng = random.Random(8)
    texts = sample() + unlike(rng, 150, 120, 4)
    rows = docs(list(enumerate(texts))).repartition(5)
    want = kept_by_force(texts)
    for limits in ({"cell": 16, "most_blocks": 1000}, {"cell": 16, "most_blocks": 1, "depth": 2}):
        assert sorted(r.doc for r in nearcopies.firsts(rows, "doc_id", **limits).collect()) == want, limits


def test_what_minima_miss_in_large_buckets_is_found_by_prefixes(spark, docs, monkeypatch):
    rng = random.Random(8)
    texts = sample() + unlike(rng, 150, 120, 4)
    apart = lambda sets, level: sets.select("doc", nearcopies.F.lit(0).alias("band"), nearcopies.F.col("doc").alias("finer"))
    monkeypatch.setattr(nearcopies, "_finer_keys", apart)
    rows = docs(list(enumerate(texts))).repartition(5)
    assert sorted(r.doc for r in nearcopies.firsts(rows, "doc_id", cell=2, most_blocks=1).collect()) == kept_by_force(texts)


def test_two_thousand_unlike_copies_give_rows_in_proportion(spark, docs, monkeypatch):
    rng, counts = random.Random(9), []
    keep = nearcopies._linked

    def counted(cells, sets):
        out = keep(cells, sets).cache()
        counts.append((cells.count(), out.count()))
        return out

    monkeypatch.setattr(nearcopies, "_linked", counted)
    texts = unlike(rng, 2000, 100, 4)
    got = sorted(r.doc for r in nearcopies.firsts(docs(list(enumerate(texts))).repartition(8), "doc_id").collect())
    assert got == kept_by_force(texts)
    assert sum(links for _, links in counts) <= 2000 * nearcopies.BANDS
    assert sum(cells for cells, _ in counts) <= 2000 * nearcopies.BANDS * (2 * nearcopies.MOST_BLOCKS + 1)


def test_common_counts_and_forest():
    rng = random.Random(2)
    make = lambda: nearcopies.np.array(sorted(rng.sample(range(60), rng.randint(1, 40))), nearcopies.np.uint64)
    for size in (2, 3, 30):
        sets = [make() for _ in range(size)]
        want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
        got = nearcopies.common_counts(sets)
        assert all(got[a][b] == want[a][b] for a in range(size) for b in range(size) if a != b)
    one = nearcopies.np.arange(10, dtype=nearcopies.np.uint64)
    links = nearcopies.forest([one, one[:9], one[:8], one + nearcopies.np.uint64(50)], nearcopies.np.array([5, 6, 7, 8]))
    assert sorted(map(sorted, zip(*links, strict=True))) == [[0, 1], [0, 2]]
    assert nearcopies.forest([one, one[:9]], nearcopies.np.array([5, 5])) == ([], [])
