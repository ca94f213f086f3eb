import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from exactsync.llm import quality


def test_shallow_tree_finds_the_steps():
    grad = np.array([1.0] * 10 + [-2.0] * 10 + [3.0] * 5)
    got = quality.shallow_tree(grad, np.full(25, 1e6))
    assert len(set(got.tolist())) == 3 and got[0] != got[10] != got[20]


def test_score_is_the_sum_of_looked_up_bins():
    rng = np.random.default_rng(0)
    rows = rng.random((3000, len(quality.FEATURES)))
    # An exclusive or of two features: only the pair tables can learn it.
    labels = ((rows[:, 2] > 0.5) ^ (rows[:, 7] > 0.5)).astype(float)
    model = quality.Model(rows, labels)
    assert any({a, b} == {2, 7} for a, b, _ in model.pairs)
    scores = model.score(rows)
    assert ((scores > 0.5) == labels).mean() > 0.9
    one = model.base
    for f, edges in enumerate(model.edges):
        one += model.tables[f][sum(rows[0, f] >= e for e in edges)]
    for a, b, t in model.pairs:
        one += t[sum(rows[0, a] >= e for e in model.coarse[a]), sum(rows[0, b] >= e for e in model.coarse[b])]
    assert abs(scores[0] - 1 / (1 + np.exp(-one))) < 1e-12


def test_held_out_accuracy_and_edge_cases(docs, spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(800):
        words = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.2
        text = "!! ".join(w.upper() for w in words) if bad and i % 2 else " | ".join(words) if bad else " ".join(words) + "."
        rows.append((i, text))
        labels.append((i, int(not bad)))
    rows += [(900, None), (901, ""), (902, "x" * 200_000), (None, "one two."), (5, rows[5][1])]
    table = spark.createDataFrame([*labels, (1, None), (950, 1), (None, 0), (2, labels[2][1])], "doc_id long, quality int")
    df = docs(rows)
    got = quality.scored(df, quality.fit(df, table)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held) and len(held) > 100
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    nothing = quality.scored(df, quality.fit(df, table.where(F.lit(False)))).collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality.scored(docs([]), quality.fit(docs([]), table)).collect() == []
