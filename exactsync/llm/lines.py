"""Line deduplication with DataFrame functions only: hash, range-partition, stream, return bitmaps.

Lines become 128-bit hashes of their key (stripped of ASCII white space, A-Z lowered) with document and
position. Keys seen too rarely are dropped by a counting pre-aggregation. The rest is range-partitioned
by hash and slice of the documents (a key that fills a third of all documents spreads over
the slices), sorted inside by document and position, and streamed: the first line of a key in each
document counts that document. Per document the decisions come back as a compressed bitmap, words of
63 lines without the words in which everything stays, never as text.

Defined cases: a null or empty text is one empty line; an empty key is never dropped; a key repeated inside a document counts
it once; rows are documents, so repeated rows count each (and share their bitmap); a null id is a value like others; other columns
are carried along by :func:`dedupe_lines` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exactsync.llm.shared import SPACES, ascii_lower, digest, partition_count, staged

MIN_DOCUMENTS = 10
SLICES = 64
_WORD = 63


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def line_hashes(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """``id``, ``print`` (hash of the text), ``copy`` (the row's own number), ``pos``, ``h1``, ``h2`` of every line with a key."""
    whole = docs.select(
        F.col(id_column).alias("id"), _text(text_column).alias("text"), F.monotonically_increasing_id().alias("copy")
    )
    rows = whole.select(
        "id", F.xxhash64("text").alias("print"), "copy", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    )
    keyed = rows.withColumn("key", ascii_lower(F.trim(F.col("line"), F.lit(SPACES))))
    h1, h2 = digest(F.col("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "id", "print", "copy", "pos", h1.alias("h1"), h2.alias("h2")
    )


def repeated_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = 1,
    keep_first: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id``, ``print``, ``pos`` of the lines to drop: those whose key is in ``min_documents`` documents or more.

    ``keep_first`` spares the first of them by document and position (in all rows that repeat that document).
    """
    spark = docs.sparkSession
    lines = staged(line_hashes(docs, id_column, text_column, max(1, min_chars)), "lines")
    often = staged(
        lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents).select("h1", "h2"),
        "candidates",
    )
    some = lines.join(often, ["h1", "h2"], "left_semi").withColumn("slice", F.pmod(F.xxhash64("copy"), F.lit(SLICES)))
    ranged = some.repartitionByRange(partition_count(spark), "h1", "h2", "slice")
    in_order = Window.partitionBy("h1", "h2", "slice").orderBy("id", "print", "copy", "pos")
    first = F.lag("copy").over(in_order)
    streamed = ranged.withColumn("first", F.coalesce(first != F.col("copy"), F.lit(True)))
    place = F.struct("id", "print", "pos")
    totals = [F.count_if("first").alias("documents")] + ([F.min(place).alias("place")] if keep_first else [])
    by_key = streamed.groupBy("h1", "h2").agg(*totals).where(F.col("documents") >= min_documents)
    frequent = staged(by_key.drop("documents"), "frequent")
    dropped = lines.join(frequent, ["h1", "h2"])
    if keep_first:
        dropped = dropped.where(~place.eqNullSafe(F.col("place")))
    return dropped.select("id", "print", "pos")


def bitmaps(dropped: DataFrame) -> DataFrame:
    """One row per document that loses lines: ``words`` maps the number of a word of 63 lines to its dropped bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("pos"), F.lit(_WORD)))
    words = dropped.groupBy("id", "print", F.floor(F.col("pos") / _WORD).cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    return words.groupBy("id", "print").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def apply_bitmaps(docs: DataFrame, maps: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row`` (the document's own columns), ``kept`` (its text after dropping), ``n_lines``, ``n_dropped``."""
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_column).alias("doc"),
        _text(text_column).alias("whole"),
    ).withColumn("hash", F.xxhash64("whole"))
    same = rows["doc"].eqNullSafe(maps["id"]) & (rows["hash"] == maps["print"])
    joined = rows.join(maps.hint("merge"), same, "left")  # bitmaps grow with the documents: never broadcast them

    def stays(_line: Column, at: Column) -> Column:
        word = F.coalesce(F.try_element_at("words", F.floor(at / _WORD).cast("int")), F.lit(0).cast("long"))
        return F.getbit(word, F.pmod(at, F.lit(_WORD))) == 0

    lines = F.split("whole", "\n", -1)
    kept = F.array_join(F.filter(lines, stays), "\n")
    return joined.select(
        "row",
        F.when(F.col("n_dropped").isNull(), F.col("whole")).otherwise(kept).alias("kept"),
        (F.char_length("whole") - F.char_length(F.replace("whole", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
    )


def dedupe_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents with ``kept``, ``n_lines`` and ``n_dropped``, see :func:`apply_bitmaps`."""
    dropped = repeated_lines(docs, id_column=id_column, text_column=text_column, **options)
    return apply_bitmaps(docs, staged(bitmaps(dropped), "bitmaps"), id_column, text_column)
