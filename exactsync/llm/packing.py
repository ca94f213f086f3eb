"""Concatenate and cut: documents become one long stream of token ids, cut into fixed windows.

Pass one tokenizes each input partition once and stages its ids with the running total inside the
partition. The totals of the partitions (one row each) are summed to global offsets, and pass two cuts
every document where its global span crosses a window; a document that crosses leaves one boundary
record on each side. Nothing is shuffled but the one row per partition. Only the very last window can
be short.

The order of the stream is that of the rows as they were read, which the staged table fixes for the rest of the
run. Defined cases: a null text is empty, so its only id is the separator; repeated rows are packed one
by one; a null id stays null; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.llm.shared import staged
from exactsync.llm.tokens import PRE_TOKEN, ChunkCache, SpecialCut, byte_symbols, chunk_values

SEPARATOR = 0
WINDOW = 1024


class IdEncoder:
    """Token ids of a text as little-endian bytes: the ids the ``tokenizers`` library gives for the file.

    Chunks (up to a space; a pre-token never crosses such a cut) are looked up in a cache. A new chunk is
    encoded by ``tiktoken`` from the same file's vocabulary, which is about eight times faster on short strings;
    the tests hold its ids against ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut, vocabulary = spec["pre_tokenizer"], spec["model"]["vocab"]
        if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path} does not cut text as a plain byte-level vocabulary does")
        self.special = SpecialCut(spec["added_tokens"])
        byte = {s: b for b, s in enumerate(byte_symbols())}
        specials = set(self.special.ids)
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in specials}
        self.encode = tiktoken.Encoding(
            "file", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_ordinary
        top = max([*ranks.values(), *self.special.ids.values()])
        self.kind = "H" if top < 1 << 16 else "I"  # two bytes an id where they are enough
        self.chunks = ChunkCache(self._chunk)

    @property
    def dtype(self) -> str:
        return "<u2" if self.kind == "H" else "<u4"

    def _chunk(self, chunk: str) -> bytes:
        return array(self.kind, self.encode(chunk)).tobytes()

    def ids(self, text: str) -> bytes:
        parts, specials = self.special.parts(text)
        out = chunk_values(parts[0], self.chunks)
        for token, part in zip(specials, parts[1:], strict=True):
            out.append(array(self.kind, [token]).tobytes())
            out += chunk_values(part, self.chunks)
        return b"".join(out)


_ENCODERS: dict[str, IdEncoder] = {}


def encoder(path: str) -> IdEncoder:
    """The encoder of a vocabulary, read once per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]


def tokenized(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Staged rows of ``lane`` (the partition), ``begin`` (ids before the document there), ``doc_id``,
    ``doc_tokens`` and ``ids`` (bytes, the separator included)."""
    id_type = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("lane", T.LongType()),
            T.StructField("begin", T.LongType()),
            T.StructField("doc_id", id_type),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        lane, total = TaskContext.get().partitionId(), 0
        end, width = np.array([SEPARATOR], tool.dtype).tobytes(), int(tool.dtype[-1])
        for batch in batches:
            ids = [(tool.ids(t) if t else b"") + end for t in batch.column("text").to_pylist()]
            sizes = np.array([len(x) // width for x in ids], np.int64)
            ends = total + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), lane, np.int64)),
                    pa.array(ends - sizes),
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(ids, pa.binary()),
                ],
                schema.names,
            )
            total = int(ends[-1]) if len(ends) else total

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return staged(rows.mapInArrow(encode, schema), "tokens")


def lane_offsets(tokens: DataFrame) -> DataFrame:
    """Global offset of each partition: a prefix sum over one row per partition."""
    totals = tokens.groupBy("lane").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("lane", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shift"))


def pieces(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document in a window."""
    schema = T.StructType(
        [
            T.StructField("doc_id", tokens.schema["doc_id"].dataType),
            *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")),
            *(T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            columns: list[tuple] = []
            sizes, at = batch.column("doc_tokens").to_pylist(), batch.column("at").to_pylist()
            for row, (ids, size, place) in enumerate(zip(batch.column("ids"), sizes, at, strict=True)):
                raw, start = ids.as_py(), 0
                data = np.frombuffer(raw, f"<u{len(raw) // size}").astype("<u4").data.cast("B")
                while start < size:
                    here = place + start
                    length = min(size - start, window - here % window)
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append(row)
                    columns.append((start, length, crc, size, here // window, here % window))
                    start += length
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    *(pa.array([c[i] for c in columns], pa.int64()) for i in range(6)),
                ],
                schema.names,
            )

    # One row per input partition: about 16 bytes each, so even a million partitions are a small broadcast.
    placed = tokens.join(F.broadcast(lane_offsets(tokens)), "lane")
    return placed.select(
        "doc_id", "doc_tokens", "ids", (F.col("shift") + F.col("begin")).alias("at")
    ).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, vocabulary: str, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Pack documents into sequences of at most ``window`` ids."""
    return pieces(tokenized(docs, vocabulary, id_column, text_column), window)
