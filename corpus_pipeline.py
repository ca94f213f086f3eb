"""Corpus pipeline: language, repeated lines, near copies, source mix, packing.

``STAGES`` holds (name, function) pairs. A function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exactsync.llm import language, lines, mixing, nearcopies, packing
from exactsync.llm.queries import byte_bpe
from exactsync.llm.shared import prepare, staged


def _name(column: str) -> str:
    """A column name as Spark reads it, whatever characters are in it."""
    return "`" + column.replace("`", "``") + "`"


def _enveloped(docs: DataFrame) -> DataFrame:
    """``text`` and ``row``, a struct of all other columns: columns that an operator adds cannot clash with them."""
    others = [F.col(_name(c)).alias(f"c{n}") for n, c in enumerate(docs.columns) if c != "text"]
    return docs.select("text", F.struct(*others).alias("row"))


def _opened(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that :func:`_enveloped` was given."""
    return rows.select(*((F.col("text") if c == "text" else F.col(f"row.c{n}")).alias(c) for n, c in enumerate(columns)))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language was recognised.

    Null and empty texts and texts without any letter have none and go; so does everything if no row has a language to
    learn from. Texts of any length are read whole; equal texts get equal answers, and of languages that parse a text equally well the
    first by name wins; repeated rows all stay or all go. An empty table stays empty; other columns are carried along."""
    prepare(spark)
    found = language.predicted(_enveloped(docs), language.learn(docs))
    return _opened(found.where(F.col("lang_pred") != language.UNKNOWN), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share, but for the first place of each (by id, text and position), so that
    the text of a large group of copies stays in one of them.

    A document may become empty; a null text becomes an empty one, which is one line without a key and is never dropped. Repeated rows
    count as documents of their own and share their fate; a null id is a value like others. Texts of any length are split
    whole; ``n_chars`` is counted anew. An empty table stays empty; other columns are carried along."""
    prepare(spark)
    done = lines.dedupe_lines(docs, keep_first=True)
    text = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return done.select(*(text.get(c, F.col(f"row.{_name(c)}")).alias(c) for c in docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first read, of each class of near copies (five-word shingles, Jaccard similarity of 0.8 or more).

    Rows are told apart by number, not by id, so repeated rows are copies of which one stays and null ids do no harm. Null and empty
    texts are one class; a text of fewer than five words is one shingle. Texts of any length are compared whole. An empty
    table stays empty; other columns are carried along."""
    prepare(spark)
    rows = staged(_enveloped(docs).withColumn("number", F.monotonically_increasing_id()), "rows")
    first = nearcopies.firsts(rows, "number").withColumnRenamed("doc", "number")
    return _opened(rows.join(first.hint("merge"), "number", "left_semi"), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: whole texts, as often as it takes them, and parts.

    Null, empty and blank texts have no words, so nothing is taken of them; null sources are one source, the last. Repeated rows
    are dealt one by one, ties go by a seeded hash and row number. A long text may be cut between words. An empty table stays
    empty; other columns are carried along and repeated with their text."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens.

    A null or empty text is its end token alone; a long text is cut as often as needed; repeated rows are packed one by one, in the
    order read. An empty table gives no pieces. Other columns are not read."""
    prepare(spark)
    return packing.pack(docs, byte_bpe())


STAGES = [
    ("language", keep_known_languages),
    ("lines", drop_repeated_lines),
    ("near_copies", keep_one_of_each_group),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Language models, covering hashes and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
