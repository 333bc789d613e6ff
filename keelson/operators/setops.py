"""Unions. A union is a narrow operation in Spark: the inputs' partitions are
concatenated, nothing is shuffled (no Exchange under a Union)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Positional union that keeps duplicates (``union`` == ``unionAll``).

    Columns are matched by position, so names come from ``first``; the
    column counts must agree.
    """
    out = first
    for o in others:
        if len(o.columns) != len(first.columns):
            raise ValueError(f"positional union needs equal column counts: "
                             f"{first.columns} vs {o.columns}")
        out = out.union(o)
    return out


def union_by_name(first: DataFrame, *others: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union matching columns by name (case-insensitive); with
    ``allow_missing`` a column absent on one side is NULL there."""
    out = first
    for o in others:
        out = out.unionByName(o, allowMissingColumns=allow_missing)
    return out
