"""Registry of named queries and the input frames they start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from exactsync.session import configure

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``{table}`` in its oracle names a table."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = plain(oracle)
        return fn

    return register


def plain(text: str) -> str:
    """SQL with its ``{table}`` placeholders filled by the bare names."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Input rows from SQL both engines understand."""
    used = {name: load(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)
