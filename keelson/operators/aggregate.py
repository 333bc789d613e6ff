"""Aggregation, collection, pivot, unpivot and distinct.

Every aggregate here is decomposable (partial aggregation before the
shuffle), so a key holding a third of all rows is combined inside each map
task before it reaches one reducer. Collected lists are built from
(group, value, count) rows for the same reason; only the final projection
expands a group's list, whose length is the group's row count by definition.
A group too large for one list is collected in chunks (``collect_chunks``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import stage_parquet


def grouped(df: DataFrame, by: Sequence[str | Column], aggs: Sequence[Column]) -> DataFrame:
    """``groupBy(by).agg(aggs)``; an empty ``by`` is one global row."""
    if not aggs:
        raise ValueError("at least one aggregate is needed")
    return df.groupBy(*by).agg(*aggs)


def collect_values(df: DataFrame, by: Sequence[str], col: str, distinct: bool = False,
                   name: str | None = None) -> DataFrame:
    """Per group, the sorted list (or set) of non-NULL values of ``col``
    (``sort_array(collect_list(col))`` / ``collect_set``).

    Built from ``value_counts``: rows are first reduced to one (group,
    value, count) row, decomposably (partial counts in every map task), so
    a group holding a third of the rows is not buffered whole by one task;
    the final aggregate holds one entry per distinct value of a group, and
    the list is expanded from the counts only in the final projection.
    """
    out_name = name or f"{col}_{'set' if distinct else 'list'}"
    counts = value_counts(df, by, col, "__n")
    entries = F.array_sort(F.collect_list(F.struct(F.col(f"`{col}`").alias("v"),
                                                   F.col("__n").alias("n"))))
    grouped = counts.groupBy(*by).agg(entries.alias("__e"))
    present = F.filter("__e", lambda e: e["v"].isNotNull())
    if distinct:
        values = F.transform(present, lambda e: e["v"])
    else:
        values = F.flatten(F.transform(present, lambda e: F.array_repeat(e["v"], e["n"].cast("int"))))
    return grouped.select(*by, values.alias(out_name))


def collect_chunks(df: DataFrame, by: Sequence[str], col: str, size: int, distinct: bool = False,
                   name: str | None = None) -> DataFrame:
    """The list of ``collect_values`` cut into lists of ``size`` values, for
    groups that no single value can hold: one row for each (group, ``chunk``
    from 0), values ascending within and across a group's chunks, the last one
    shorter. A group without non-NULL values has no chunk.

    A group is never in one task. Its (value, count) rows are dealt by ranges
    of (group, value), so a large group spans several ranges, and staged with
    their range. Each range counts its rows of each group; running totals of
    these counts (one row for each group and range) place every value, and a
    value's copies fill as many chunks as they need.
    """
    out_name = name or f"{col}_{'set' if distinct else 'list'}"
    by, spark = list(by), df.sparkSession
    counts = value_counts(df.filter(F.col(f"`{col}`").isNotNull()), by, col, "__n")
    if distinct:
        counts = counts.withColumn("__n", F.lit(1).cast("long"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage_parquet(counts.repartitionByRange(n, *by, col).withColumn(
        "__range", F.spark_partition_id()), "value-ranges")
    totals = ranged.groupBy(*by, "__range").agg(F.sum("__n").alias("__rows"))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    same = [F.col(f"r.`{c}`").eqNullSafe(F.col(f"t.`{c}`")) for c in [*by, "__range"]]
    placed = ranged.alias("r").join(totals.alias("t"), reduce(lambda a, b: a & b, same)).select(
        *[F.col(f"r.`{c}`") for c in [*by, col, "__n", "__range"]], "__before")
    inside = Window.partitionBy(*by, "__range").orderBy(col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.col("__before") + F.sum("__n").over(inside)
    placed = placed.withColumn("__end", end).withColumn("__start", F.col("__end") - F.col("__n"))
    first, last = F.expr(f"__start div {size}"), F.expr(f"(__end - 1) div {size}")
    cut = placed.withColumn("chunk", F.explode(F.sequence(first, last)))
    held = (F.least("__end", (F.col("chunk") + 1) * size)
            - F.greatest("__start", F.col("chunk") * size)).cast("int")
    entries = F.array_sort(F.collect_list(F.struct(F.col(f"`{col}`").alias("v"), held.alias("n"))))
    values = F.flatten(F.transform("__e", lambda e: F.array_repeat(e["v"], e["n"])))
    return cut.groupBy(*by, "chunk").agg(entries.alias("__e")).select(
        *by, "chunk", values.alias(out_name))


def value_counts(df: DataFrame, by: Sequence[str], col: str, name: str = "n") -> DataFrame:
    """The multiset form of a collected list: one row per (group, value) with
    its count. Fully decomposable, so hot groups are pre-aggregated map-side."""
    return df.groupBy(*by, col).agg(F.count(F.lit(1)).alias(name))


def pivot(df: DataFrame, index: Sequence[str | Column], column: str,
          aggs: Column | Sequence[Column], values: Sequence | None = None,
          others: str = "error", other_name: str = "other") -> DataFrame:
    """Group by ``index`` and spread ``column``'s values into columns.

    Pass ``values`` when they are known: Spark then skips the extra job that
    finds the distinct values, and the output schema is fixed. With one
    aggregate the columns are named after the values; with several,
    ``<value>_<alias>``. Use ``F.count(F.lit(1))`` for a row count
    (``count('*')`` is refused inside a pivot).

    A row whose value (NULL included) is not among ``values`` raises while
    the plan runs (``others="error"``), or is counted in a column
    ``other_name`` (``others="column"``); both in the same aggregation.
    """
    if others not in ("error", "column"):
        raise ValueError("others must be 'error' or 'column'")
    aggs = [aggs] if isinstance(aggs, Column) else list(aggs)
    if values is None:
        return df.groupBy(*index).pivot(column).agg(*aggs)
    values = list(values)
    known = F.coalesce(F.col(column).isin(*values), F.lit(False))
    text = F.col(column).cast("string")
    if others == "error":
        problem = F.concat(F.lit(f"pivot: value of {column} not in the list: "),
                           F.coalesce(text, F.lit("NULL")))
        df = df.filter(F.when(known, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))
    else:
        if other_name in [str(v) for v in values]:
            raise ValueError(f"{other_name!r} is one of the values")
        df = df.withColumn(column, F.when(known, text).otherwise(F.lit(other_name)))
        values = [str(v) for v in values] + [other_name]
    return df.groupBy(*index).pivot(column, values).agg(*aggs)


def unpivot(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
            name_col: str = "name", value_col: str = "value",
            include_nulls: bool = True) -> DataFrame:
    """Columns to rows (the ``stack(n, 'a', a, ...)`` form).

    ``include_nulls=True`` keeps a row for a NULL cell, like ``stack``; SQL's
    ``UNPIVOT`` drops them, which ``include_nulls=False`` gives.
    """
    out = df.unpivot(list(ids), list(value_cols), name_col, value_col)
    return out if include_nulls else out.filter(F.col(value_col).isNotNull())


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``cols`` (partial dedup per task, then one shuffle)."""
    return df.select(*cols).distinct()
