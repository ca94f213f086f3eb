import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from exactsync.llm import vectors
from exactsync.llm.shared import prepare


def by_hand(rows, threshold=0.95):
    units = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), name) if x is not None), default=None)
    out = []
    for i, (name, _) in enumerate(rows):
        c = least[find(i)] if units[i] is not None else name
        out.append((name, links[i], c, name is not None and name == c))
    return sorted(out, key=repr)


def some_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(150)]
    centre = rng.standard_normal(16)
    rows += [(200 + i, (centre + rng.standard_normal(16) * 0.15).tolist()) for i in range(120)]
    chain = rng.standard_normal(16)
    for i in range(40):
        chain = chain / np.linalg.norm(chain) + rng.standard_normal(16) * 0.07
        rows.append((400 + i, chain.tolist()))
    rows += [(500 + i, (centre * 3).tolist()) for i in range(50)]
    rows += [(600, [0.0] * 16), (601, None), (602, []), (603, [1.0, None] + [0.0] * 14), (604, [float("nan")] * 16)]
    rows += [(605, [float("inf")] + [0.0] * 15), (606, [1.0, 2.0]), (607, [2.0, 4.0]), (None, (centre * 2).tolist())]
    rows += [(608, [1e30] * 16), (609, [1e-30] * 16), (606, [1.0, 2.0]), (None, [5.0, -1.0])]
    return rows


@pytest.mark.parametrize("cell", [16, 1024])
def test_against_all_pairs(spark, cell):
    prepare(spark)
    rows = some_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({n: F.lit(1) for n in ("node", "table", "key", "print", "label", "least")})
    got = vectors.near_duplicates(df, recall=0.999999, cell=cell).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows)


def test_float_vectors_and_empty_table(spark):
    prepare(spark)
    rows = [(i, [float(i % 3), 1.0, 0.5]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vectors.near_duplicates(df, recall=0.999999).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows)
    assert vectors.near_duplicates(df.limit(0)).collect() == []
