import random

import pytest
from tokenizers import Tokenizer

from exactsync.llm import packing, tokens
from exactsync.llm.queries import byte_bpe

ALPHABET = [*"ab tion   \n\t\r'sdll  12٣½éñçß中文🚀!?.,;_-\x1c\x1f \u0085 \x00", "<|endoftext|>", "  ", " \n", "the", " a"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_bpe())


def random_texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_counts_and_ids_equal_the_library(library):
    import numpy as np

    counter, encoder = tokens.MergeCounter(byte_bpe()), packing.IdEncoder(byte_bpe())
    for text in random_texts(4000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(ids), text
        assert np.frombuffer(encoder.ids(text), encoder.dtype).tolist() == ids, text


def test_code_points_of_all_planes(library):
    import numpy as np

    counter, encoder = tokens.MergeCounter(byte_bpe()), packing.IdEncoder(byte_bpe())
    rng = random.Random(5)
    disputed = [0x558, 0x1C89, 0x2427, 0x3FC3F, 0x1F4B1, 0x2FFFC, 0x31350, 0x323B0, 0x10D40, 0x1E5F0, 0xA7CB, 0x11F5A, 0x2EBF0, 0xFFFFF, 0x10FFFF]
    points = disputed + [p for p in range(0x80, 0x110000, 997) if not 0xD800 <= p < 0xE000] + [rng.randrange(0x80, 0x3FFFF) for _ in range(3000)]
    for point in points:
        if 0xD800 <= point < 0xE000:
            continue
        c = chr(point)
        for text in (f"{c}'s a{c}b 1{c}2 {c}{c}!{c} é{c}", f" {c}a  {c}1\n{c}"):
            ids = library.encode(text, add_special_tokens=False).ids
            assert counter.count(text) == len(ids), hex(point)
            assert np.frombuffer(encoder.ids(text), encoder.dtype).tolist() == ids, hex(point)


def test_full_caches_change_nothing():
    counter = tokens.MergeCounter(byte_bpe())
    small = tokens.MergeCounter(byte_bpe())
    small.words.limit = small.chunks.limit = 3
    for text in random_texts(300, 2):
        assert counter.count(text) == small.count(text)


def test_long_pre_tokens(library):
    for text in ("a" * 20_000, " " * 5000 + "x", "é" * 3000, "\n" * 4000):
        assert tokens.counter(byte_bpe()).count(text) == len(library.encode(text).ids)


def test_operator_and_edge_cases(docs, library):
    rows = [(0, None), (1, ""), (2, "hello world"), (2, "hello world"), (None, "é🚀"), (3, "<|endoftext|> x"), (4, "word " * 3000)]
    got = sorted(map(tuple, tokens.count_tokens(docs(rows), byte_bpe()).collect()), key=repr)
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert got == sorted(want, key=repr)
    assert tokens.count_tokens(docs([]), byte_bpe()).collect() == []
