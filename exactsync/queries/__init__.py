"""Registered checks: each operator over the given tables, with the same result as DuckDB SQL."""

from exactsync.queries.registry import ORACLES, QUERIES
from exactsync.queries import batches, casts, jobs, ledger, mapping, scans, verify, writes  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
