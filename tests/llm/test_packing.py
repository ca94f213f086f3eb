import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from exactsync.llm import packing
from exactsync.llm.queries import byte_bpe


def check(pieces, rows, window):
    library = Tokenizer.from_file(byte_bpe())
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == np.append(0, np.cumsum([p.length for p in parts]))[:-1].tolist()
        assert sum(p.length for p in parts) == len(ids[i]) and {p.doc_tokens for p in parts} == {len(ids[i])}
        for p in parts:
            data = np.array(ids[i][p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(data) and p.length > 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    fills = []
    for s in sorted(by_sequence):
        at = 0
        for p in sorted(by_sequence[s], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        fills.append(at)
    assert all(f == window for f in fills[:-1]) and 0 < fills[-1] <= window


@pytest.mark.parametrize("window", [1024, 7])
def test_every_id_lies_in_one_piece(docs, window):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice(["alpha", "bé", "<|endoftext|>", "x\n"]) for _ in range(rng.choice([0, 3, 90])))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "long text " * 3000)]
    got = packing.pack(docs(rows).repartition(5), byte_bpe(), window).collect()
    check(got, rows, window)


def test_repeated_rows_and_empty_table(docs):
    got = packing.pack(docs([(1, "same"), (1, "same"), (None, "no id")]), byte_bpe()).collect()
    assert sorted((str(p.doc_id), p.start) for p in got) == [("1", 0), ("1", 0), ("None", 0)]
    assert packing.pack(docs([]), byte_bpe()).collect() == []
