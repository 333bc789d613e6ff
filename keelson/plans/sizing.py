"""Proven size bounds for broadcast decisions.

A side is broadcast by hand only after it has been shown to be small:
``size_bound`` adds up the rows and bytes of at most ``max_rows + 1`` rows
in one aggregate, of which one row reaches the driver. The probe reads its
input until it has that many rows, which for a selective filter may be all
of it, so it is made only where the caller asked for a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed defaults for the broadcast bound (both must hold).
DEFAULT_MAX_ROWS = 200_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class SizeBound:
    rows: int
    bytes: int


def row_bytes(schema: T.StructType) -> Column:
    """An estimate of a row's in-memory size: 8 bytes per fixed-width value,
    the UTF-8 length for text and binary, the JSON text for nested values."""
    total = F.lit(8 * len(schema.fields) + 8).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return total


def size_bound(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
               max_bytes: int = DEFAULT_MAX_BYTES) -> SizeBound | None:
    """The exact row count and estimated bytes of ``df`` if it is within both
    bounds, else None."""
    found = df.select(row_bytes(df.schema).alias("b")).limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    if found["n"] > max_rows or found["b"] > max_bytes:
        return None
    return SizeBound(int(found["n"]), int(found["b"]))


def broadcast_limits(spark) -> tuple[int, int]:
    """Bounds from the session (``keelson.broadcast.maxRows`` /
    ``keelson.broadcast.maxBytes``), else the fixed defaults."""
    rows = int(spark.conf.get("keelson.broadcast.maxRows", str(DEFAULT_MAX_ROWS)))
    size = int(spark.conf.get("keelson.broadcast.maxBytes", str(DEFAULT_MAX_BYTES)))
    return rows, size
