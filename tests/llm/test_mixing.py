import random
from collections import Counter, defaultdict

import pytest

from exactsync.llm import mixing


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {s for s in names if not sizes[s]}
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        level = rest / open_weight if open_weight else 0
        over = {s for s in names if s not in full and weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


def sainte_lague(votes, stop, blocks):
    won = dict.fromkeys(votes, 0)
    for _ in range(min(blocks, sum(stop.values()))):
        best = min((c for c in votes if won[c] < stop[c]), key=lambda c: (-votes[c] / (2 * won[c] + 1), c))
        won[best] += 1
    return won


def some_rows(seed=4):
    rng = random.Random(seed)
    rows, n = [], 0
    for source, docs, longest in (("hot", 900, 300), ("éa", 40, 200), ("Z", 30, 40), (None, 3, 9), ("tiny", 1, 4), ("", 60, 100)):
        for _ in range(docs):
            rows.append((n, " \n".join(f"w{j}" for j in range(rng.randint(0, longest))), None, source))
            n += 1
    return [*rows, (n, None, None, "hot"), (n, None, None, "hot"), (None, "a b c", None, "Z"), rows[5], rows[5], (n + 1, "", None, "empty")]


def words(text):
    return (text or "").encode().split()


def test_targets_and_taken(docs):
    rows = some_rows()
    got = mixing.mix(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = targets_by_hand(sizes)
    source = {i: s for i, _, _, s in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2, 0.02 * t), (s, taken[s], t)
    again = mixing.mix(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in got) == sorted((str(r.doc_id), r.taken) for r in again)


@pytest.mark.parametrize("blocks", [0, 1, 7, 100, 5000])
def test_apportionment_takes_the_highest_quotients(spark, docs, blocks):
    rng = random.Random(blocks)
    votes = {c: float(rng.choice([1, 2, 2, 5, 100, rng.random() * 40])) for c in range(60)}
    stop = {c: rng.randint(1, 120) for c in votes}
    cells = spark.createDataFrame([(c, votes[c], stop[c]) for c in votes], "cell long, votes double, stop long")
    got = {r.cell: r.quota for r in mixing.apportion(cells, blocks).collect()}
    assert got == sainte_lague(votes, stop, blocks)


def test_documents_of_the_mix(docs):
    rows = some_rows(8)
    df = docs(rows)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    plan = Counter()
    for r in mixing.mix(df).collect():
        plan[r.doc_id] += r.taken
    got, texts = Counter(), defaultdict(list)
    for i, t, _, _ in rows:
        texts[i].append(t or "")
    for r in out.collect():
        assert any(r.text in t for t in texts[r.doc_id]) and r.n_chars == len(r.text)
        got[r.doc_id] += len(words(r.text))
    assert sum(got.values()) == pytest.approx(sum(plan.values()), rel=0.01)


def test_empty_tables(docs):
    assert mixing.mix(docs([])).collect() == []
    assert [r.taken for r in mixing.mix(docs([(1, None), (2, "")])).collect()] == [0, 0]
    assert mixing.mixed_documents(docs([(1, None)])).collect() == []
