"""Incremental loads: a full load once, then batches past a high-water mark.

``new_rows`` keeps the rows of ``source`` whose ordering column is past the
largest value already in ``target``. The mark is read first (one aggregate
over the target's column, partial per task; one value reaches the driver, as
text, so no driver time zone touches it) and the batch filter is then a
literal comparison, which the parquet scan pushes down: row groups whose
statistics lie below the mark are skipped, so a daily batch reads about one
day of a date-ordered table, not all of it. ``lazy=True`` keeps the mark as a
scalar subquery inside the plan instead (no job at build time, but no
pushdown).

A later row may equal the mark, and a row may have no ordering value at all.
With ``keys`` neither is lost: rows at the mark and rows without a value
come too unless the target has their key. Without ``keys`` rows at the mark
can't be told from loaded ones and are left out, and so are rows without a
value; pass ``keys`` unless the column is unique and never NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water_mark(target: DataFrame, order_col: str) -> Column:
    """The largest ``order_col`` of ``target`` as a scalar-subquery Column."""
    return target.select(F.max(order_col)).scalar()


def new_rows(source: DataFrame, target: DataFrame, order_col: str,
             target_col: str | None = None, lazy: bool = False,
             keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``source`` past the target's high-water mark, and with
    ``keys`` (unique keys, named alike on both sides) also those at the mark
    or without a value whose keys the target lacks; all rows when the target
    has no mark (the full load)."""
    column, held = F.col(order_col), target_col or order_col
    if lazy:
        mark = high_water_mark(target, held)
        past, at = source.filter(mark.isNull() | (column > mark)), column == mark
    else:
        dtype = target.schema[held].dataType
        text = target.agg(F.max(held).cast("string").alias("mark")).first()["mark"]
        mark = F.lit(text).cast(dtype).cast(source.schema[order_col].dataType)
        past, at = (source if text is None else source.filter(column > mark)), column == mark
        if text is None:
            return source
    if keys is None:
        return past
    edge = source.filter(at | column.isNull())
    if lazy:  # a target without a mark has no rows at it, and past has all rows
        edge = edge.filter(mark.isNotNull())
    known = target.filter((F.col(held) == mark) | F.col(held).isNull()).select(*keys)
    return past.unionByName(edge.join(known, list(keys), "left_anti").select(*source.columns))
