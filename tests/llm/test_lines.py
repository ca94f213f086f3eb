import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from exactsync.llm.lines import dedupe_lines

STRIP = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least):
    seen = defaultdict(set)
    cut = [(t or "").split("\n") for _, t in rows]
    keys = [[x.strip(STRIP).translate(UPPER) for x in lines] for lines in cut]
    for n, ks in enumerate(keys):
        for k in ks:
            seen[k].add(n)
    out = []
    for (i, _), lines, ks in zip(rows, cut, keys, strict=True):
        kept = [x for x, k in zip(lines, ks, strict=True) if not k or len(seen[k]) < least]
        text = "\n".join(kept)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df, **options):
    done = dedupe_lines(df, **options)
    rows = done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("s")).collect()
    return sorted(map(tuple, rows), key=repr)


EDGE = [
    (1, "Header\nbody one\n\nHEADER \n"),
    (2, "\theader\x0b\nbody two\r\n"),
    (3, "header\nÉa\néa"),
    (4, "Éa\nx"),
    (5, None),
    (6, ""),
    (7, "\n\n"),
    (8, "header\nheader\nheader"),
    (8, "header\nother text under the same id"),
    (None, "header\nno id"),
    (9, "body one\nbody one\nonly here"),
    (10, "\n".join(f"line {i % 90}" for i in range(400)) + "\nheader"),
    (10, "\n".join(f"line {i % 90}" for i in range(400)) + "\nheader"),
]


@pytest.mark.parametrize("least", [1, 2, 3, 8])
def test_edge_cases(docs, least):
    assert result(docs(EDGE), min_documents=least) == by_hand(EDGE, least)


def test_empty_table(docs):
    assert result(docs([])) == []


def test_keep_first_spares_one_line(docs):
    rows = [(i, f"shared\nown {i}") for i in range(12)]
    kept = {r["row"]["doc_id"]: r["kept"] for r in dedupe_lines(docs(rows), keep_first=True).collect()}
    assert kept == {i: f"own {i}" if i else "shared\nown 0" for i in range(12)}
