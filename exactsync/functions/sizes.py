"""Logical row size, the measure that batch limits and the oversize guard work with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exactsync.types import of_field

# Bytes of overhead per text/binary value, and the flat size of every other value.
TEXT_OVERHEAD = 16
FLAT_BYTES = 32


def fixed_row_bytes(schema: T.StructType) -> int | None:
    """Row size if it is the same for every row, else None."""
    if any(of_field(f).kind in ("string", "binary") for f in schema.fields):
        return None
    return FLAT_BYTES * len(schema.fields)


def row_bytes(schema: T.StructType, side: str = "writer") -> Column:
    """Size of a row in bytes.

    ``writer``: text and binary take their bytes + 16 (NULL counts as empty), the rest 32.
    ``reader``: as values arrive from a driver: NULL counts 32 and decimals arrive as text.
    """
    flat = 0
    parts: list[Column] = []
    for field in schema.fields:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        kind = of_field(field).kind
        if kind in ("string", "binary"):
            size = F.octet_length(column)
        elif side == "reader" and kind == "digits":
            size = F.octet_length(column)
        elif side == "reader" and kind == "decimal":
            size = F.octet_length(column.cast("string"))
        else:
            flat += FLAT_BYTES
            continue
        if side == "reader":
            parts.append(F.coalesce(size + TEXT_OVERHEAD, F.lit(FLAT_BYTES)))
        else:
            parts.append(F.coalesce(size, F.lit(0)) + TEXT_OVERHEAD)
    total = F.lit(flat).cast("bigint")
    for part in parts:
        total = total + part.cast("bigint")
    return total


def guard_row_bytes(size: Column, limit: int) -> Column:
    """The size, failing the task on a row above ``limit``."""
    text = F.concat(F.lit("ROW_TOO_LARGE: row of "), size.cast("string"), F.lit(f" bytes exceeds {limit}"))
    return F.when(size <= limit, size).otherwise(F.raise_error(text).cast("bigint"))
