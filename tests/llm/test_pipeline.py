import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from exactsync.llm.shared import staged
from tests.llm.test_nearcopies import kept_by_force
from tests.llm.test_packing import check


@pytest.fixture
def table(docs):
    rng = random.Random(6)
    words = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(30, 80)))
        rows.append((i, text + ("\nShared line of many" if i % 4 == 0 else ""), "xx" if i % 5 else None, f"s{i % 3}"))
    rows += [(200 + i, rows[7][1], "xx", "s1") for i in range(30)]
    rows += [(300, None, "xx", "s0"), (301, "12 34", "xx", "s2"), (302, "", None, None), (7, rows[7][1], "xx", "s1"), (None, rows[9][1] + " more", "xx", None)]
    return docs(rows).select("doc_id", "text", "lang", "source", "n_chars"), rows


def test_stages(spark, table):
    docs, rows = table
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "mix", "pack"]
    kept = staged(stages["language"](spark, docs, ""), "t")
    key = lambda r: (r[0], r[1])
    assert Counter(map(key, kept.collect())) == Counter((i, t) for i, t, *_ in rows if t and any(map(str.isalpha, t)))
    lines = staged(stages["lines"](spark, kept, ""), "t")
    shared, copied, cut = "\nShared line of many", rows[7][1], Counter()
    for i, t in map(key, kept.collect()):
        cut[i, t if i == 0 else "" if t == copied else t.replace(shared, "")] += 1
    cut[7, copied] += cut.pop((7, ""))  # the first of the copies keeps the text, in both rows with its id
    assert Counter(map(key, lines.collect())) == cut
    single = staged(stages["near_copies"](spark, lines, ""), "t")
    before, after = lines.collect(), single.collect()
    assert Counter(map(tuple, after)) == Counter(tuple(before[n]) for n in kept_by_force([r.text for r in before]))
    mixed = staged(stages["mix"](spark, single, ""), "t")
    assert all(df.columns == docs.columns for df in (kept, lines, single, mixed))
    texts = {}
    for r in after:
        texts.setdefault(r.doc_id, []).append(r.text)
    assert all(any(r.text in t for t in texts[r.doc_id]) and r.n_chars == len(r.text) for r in mixed.collect())
    numbered = [(n, r.text) for n, r in enumerate(mixed.collect())]
    packed = spark.createDataFrame(numbered, "doc_id long, text string")
    check(stages["pack"](spark, packed, "").collect(), numbered, 1024)


def test_run_reads_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_stages_with_extra_columns_and_empty_tables(spark, table):
    docs, _ = table
    names = ("score", "lang_pred", "a.b", "row", "number", "row_number", "kept", "doc", "whole", "id", "print", "key", "root", "size")
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, wide.where("false"), "")
        assert empty.count() == 0
        plain, more = (staged(stage(spark, d.coalesce(1), ""), "t") for d in (docs, wide))
        if name == "pack":
            assert Counter(plain.collect()) == Counter(more.collect())
            continue
        assert empty.columns == more.columns == wide.columns
        assert Counter(plain.collect()) == Counter(more.select(*docs.columns).collect()), name
        for r in more.collect():
            assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for n in names), name
