"""Updating a partitioned table without writing all of it.

A merge returns the whole next table; for a day's batch into a table of
years that writes everything to change a little. ``merge_partitions`` finds
the partitions that hold a row the batch updates, writes only those again
(dynamic partition overwrite), and appends the inserted rows that belong to
other partitions. Files of all other partitions stay as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.merging import insert_rows, key_pairs, merge
from keelson.session import stage_parquet

#: Types whose values parquet keeps least and greatest of, row group by row group.
_RANGED = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
           T.StringType)


@dataclass(frozen=True)
class TouchedPartitions:
    """Partition values (in the order of the partition columns) that were
    written again, and those that only got new rows."""
    rewritten: list[tuple]
    appended: list[tuple]


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, on, *,
                     partition_by: Sequence[str], update: Mapping | str | None = None,
                     insert: Mapping | str | None = None, update_when: Column | str | None = None,
                     null_keys: str = "fail", check: bool = True, strategy: str = "auto",
                     schema: T.StructType | None = None) -> TouchedPartitions:
    """MERGE a batch into the Parquet table at ``path``, partitioned by
    ``partition_by`` (arguments as in ``merge``; ``schema`` fixes the types
    that the folder names would be read as).

    Partitions that hold a matching row are found first, by a semi join over
    the key and partition columns (rows outside the least and greatest key of
    the batch are skipped by the files' statistics); where the partition
    columns are merge keys, the batch names them itself. The merge reads only
    those partitions. Its rows are staged under the shared folder before
    anything is overwritten, so a run that fails in between leaves its rows
    there; the same batch run again gives the same table. A partition column
    can't be updated (its rows would leave other partitions behind), unless
    it is a merge key. The partitions' values (as many as the table has at
    most) reach the driver; rows don't.
    """
    table = spark.read.schema(schema) if schema is not None else spark.read
    target = table.parquet(path)
    parts = [next(c for c in target.columns if c.lower() == p.lower()) for p in partition_by]
    keys = key_pairs(on)
    by_key = {t.lower(): s for t, s in keys}
    changed = {c.lower() for c in (target.columns if update == "*" else update or ())}
    moved = [p for p in parts if p.lower() in changed and p.lower() not in by_key]
    if moved:
        raise ValueError(f"partition columns can't be updated: {moved}")
    if update is None and insert is None:
        raise ValueError("a merge needs update or insert")
    if update is None:
        touched = []
    elif all(p.lower() in by_key for p in parts):
        named = source.select(*[F.col(f"`{by_key[p.lower()]}`").cast(target.schema[p].dataType)
                                .alias(p) for p in parts])
        touched = _values(named.join(target.select(*parts).distinct(), parts, "left_semi"), parts)
    else:
        touched = _values(_matching(target, source, keys, parts), parts)
    if update is None:  # looks for its keys everywhere, and writes no partition again
        rows = insert_rows(target, source, on, insert, null_keys=null_keys, check=check,
                           strategy=strategy)
    else:
        rows = merge(target.filter(_among(parts, touched)), source, on, update=update, insert=insert,
                     update_when=update_when, null_keys=null_keys, check=check, strategy=strategy)
    rows = stage_parquet(rows, "merged-partitions")
    appended = _values(rows.filter(~_among(parts, touched)), parts) if insert is not None else []
    for values, mode in ((touched, "overwrite"), (appended, "append")):
        if values:
            (rows.filter(_among(parts, values)).write.mode(mode)
             .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
    spark.catalog.refreshByPath(path)
    return TouchedPartitions(touched, appended)


def _matching(target: DataFrame, source: DataFrame, keys, parts: Sequence[str]) -> DataFrame:
    """The partitions of the target rows whose key the source has."""
    types = {t: next(f.dataType for f in target.schema.fields if f.name.lower() == t.lower())
             for t, _ in keys}
    held = source.select(*[F.col(f"`{s}`").cast(types[t]).alias(f"__k{i}")
                           for i, (t, s) in enumerate(keys)])
    ranged = [(i, t) for i, (t, _) in enumerate(keys) if isinstance(types[t], _RANGED)]
    if ranged:
        ends = held.agg(*[f(f"__k{i}").alias(f"{f.__name__}{i}") for i, _ in ranged
                          for f in (F.min, F.max)]).first()
        for i, t in ranged:
            target = target.filter(F.col(f"`{t}`").between(F.lit(ends[f"min{i}"]),
                                                           F.lit(ends[f"max{i}"])))
    cond = reduce(lambda a, b: a & b, [F.col(f"`{t}`") == F.col(f"__k{i}")
                                       for i, (t, _) in enumerate(keys)])
    return target.join(held.distinct(), cond, "left_semi").select(*parts)


def _values(df: DataFrame, parts: Sequence[str]) -> list[tuple]:
    found = df.select(*[F.col(f"`{p}`") for p in parts]).distinct()
    return sorted((tuple(r) for r in found.toLocalIterator()), key=str)


def _among(parts: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether a row is in one of the partitions, as a predicate that prunes folders."""
    if not values:
        return F.lit(False)
    if len(parts) == 1:
        column, known = F.col(f"`{parts[0]}`"), [v for v, in values if v is not None]
        inside = column.isin(known) if known else F.lit(False)
        inside = F.coalesce(inside, F.lit(False))
        return (inside | column.isNull()) if len(known) < len(values) else inside
    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(f"`{p}`").eqNullSafe(F.lit(v))
                                    for p, v in zip(parts, row, strict=True)]) for row in values])
