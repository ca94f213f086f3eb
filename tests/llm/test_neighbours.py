import numpy as np
import pytest
from pyspark.sql import functions as F

from exactsync.llm import neighbours
from exactsync.llm.shared import prepare


def product(a, b):
    total = 0.0  # sum() would compensate
    for s, t in zip(a, b, strict=True):
        total += float(s) * float(t)
    return total


def by_hand(rows, k, every):
    """(query row) -> [(vec_id, score)], products summed in component order."""
    out = []
    good = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for n, (q, a) in enumerate(good):
        if q % every == 0:
            others = [(x, product(a, b)) for m, (x, b) in enumerate(good) if m != n and len(a) == len(b)]
            out += [(q, r + 1, x, s) for r, (x, s) in enumerate(sorted(others, key=lambda o: (-o[1], o[0]))[:k])]
    return out


def some_rows(n=1500, dim=12):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((9, dim)) * 2
    rows = [(i, (centres[i % 9] + rng.standard_normal(dim) * (0.2 + i % 3)).tolist()) for i in range(n)]
    rows += [(n + i, rows[40][1]) for i in range(500)]  # a large group of copies
    rows += [(10_000, None), (10_020, []), (10_040, [0.0] * dim), (10_060, [float("nan")] * dim), (None, rows[3][1])]
    rows += [(10_080, [1.0, None] + [0.0] * (dim - 2)), (20_000, [1.0, 2.0]), (20_001, [0.5, -2.0]), (20_000, [1.0, 2.0]), (40, rows[40][1])]
    return rows


def frame(spark, rows):
    prepare(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumns({n: F.lit(1) for n in ("leaf", "number", "kind", "query", "label", "vector")})


def test_all_leaves_give_the_exact_answer(spark):
    rows = some_rows()
    got = neighbours.nearest(frame(spark, rows), k=7, recall=1.0, sample=400).collect()
    want = by_hand(rows, 7, 20)
    key = lambda r: (r[0], r[1], r[2])
    true = {key(r) for r in want}
    assert len(got) == len(want) and len(true & {key(r) for r in got}) >= 0.99 * len(true)
    scores = {(r[0], r[2]): r[3] for r in want}
    assert all(scores[r.query_id, r.vec_id] == r.score for r in got if (r.query_id, r.vec_id) in scores)


def test_recall_of_a_calibrated_search(spark):
    rows = some_rows()
    got = neighbours.nearest(frame(spark, rows), k=10, recall=0.95, sample=600).collect()
    want = {(r[0], r[2]) for r in by_hand(rows, 10, 20)}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    ranks = {}
    for r in got:
        ranks.setdefault(r.query_id, []).append((-r.score, r.vec_id, r["rank"]))
    assert all([x[2] for x in sorted(v)] == sorted(x[2] for x in v) for v in ranks.values())


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 0.0])], [(20, [1.0, 0.0]), (1, [0.5, 0.5])], [(7, None)]])
def test_small_tables(spark, rows):
    got = neighbours.nearest(frame(spark, rows)).collect()
    assert [tuple(r) for r in got] == by_hand(rows, 20, 20)
