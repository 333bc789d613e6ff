"""Ordering and top-n.

A global sort is a range-partitioned shuffle (sampled bounds) followed by a
sort inside each partition; top-n is ``orderBy().limit(n)``, which Spark
plans as TakeOrderedAndProject: each task keeps its own n best rows and only
those reach the final merge, so no full sort happens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.merging import has_map


def sort_keys(keys: Sequence[str | Column], ascending: bool | Sequence[bool] = True,
              nulls_last: bool | None = None) -> list[Column]:
    """Sort expressions. By default NULLs come first ascending and last
    descending (Spark's default); ``nulls_last`` fixes one side for all keys."""
    keys = list(keys)
    asc = [ascending] * len(keys) if isinstance(ascending, bool) else list(ascending)
    if len(asc) != len(keys):
        raise ValueError("one direction per key")
    out = []
    for k, a in zip(keys, asc):
        c = F.col(k) if isinstance(k, str) else k
        if nulls_last is None:
            out.append(c.asc() if a else c.desc())
        elif nulls_last:
            out.append(c.asc_nulls_last() if a else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_first() if a else c.desc_nulls_first())
    return out


def sort_by(df: DataFrame, keys: Sequence[str | Column], ascending: bool | Sequence[bool] = True,
            nulls_last: bool | None = None, spread_ties: bool = True) -> DataFrame:
    """Global sort. The range partitioner cannot split equal keys, so one key
    holding a third of the rows would land in one task; ``spread_ties`` adds
    a last sort key, a hash of the whole row, which leaves the order by
    ``keys`` unchanged (ties have no defined order) but lets the sampled
    bounds fall inside a hot key. The hash is deterministic, so a retried
    task sends every row to the same partition. Columns that are or hold a map
    take no part in it (a map can't be hashed)."""
    order = sort_keys(keys, ascending, nulls_last)
    if spread_ties:
        hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not has_map(f.dataType)]
        if hashed:
            order.append(F.xxhash64(*hashed))
    return df.orderBy(*order)


def top_n(df: DataFrame, keys: Sequence[str | Column], n: int,
          ascending: bool | Sequence[bool] = True) -> DataFrame:
    """The first ``n`` rows in a defined order (deterministic unlike ``take``).
    Add a unique column as the last key when ties must be broken."""
    return df.orderBy(*sort_keys(keys, ascending)).limit(n)
