"""Physical layout: repartitioning, coalescing, partition profiles, laid-out writes.

``partition_profile`` is how skew is checked: rows per partition, computed
by the executors (one partial count per task), never by collecting rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.merging import has_map

#: Items that Spark's frequent-items sketch can track.
SKETCH_ITEMS = 1_000_000
LAYOUTS = ("round_robin", "hash", "range", "coalesce", "none")


def with_partition_id(df: DataFrame, name: str = "partition_id") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def lay_out(df: DataFrame, how: str, n: int | None = None,
            by: Sequence[str] = (), sort_within: Sequence[str] = (),
            salts: int | str = 1) -> DataFrame:
    """Apply a partitioning.

    - ``round_robin``: ``repartition(n)``, even sizes, a full shuffle;
    - ``hash``: ``repartition(n, *by)``, all rows of a key in one partition
      (a hot key makes a hot partition: check with ``partition_profile``).
      ``salts`` > 1 deals each key's rows into that many groups by a hash of
      the whole row, so a hot key's rows spread over up to ``salts`` partitions.
      ``salts="auto"`` finds the hot keys (``hot_keys``: a pass over the key
      columns) and deals only those, each over as many partitions as its rows
      fill (by a hash of the whole row; equal rows stay together); every other
      key stays in one partition;
    - ``range``: ``repartitionByRange(n, *by)``, sampled bounds, disjoint key
      ranges; it does not sort inside partitions, so ``sort_within`` adds that;
    - ``coalesce``: merge to ``n`` partitions without a shuffle (cannot grow);
    - ``none``: unchanged.
    """
    by = list(by)
    if how == "round_robin":
        out = df.repartition(n)
    elif how == "hash":
        if not by:
            raise ValueError("hash layout needs columns")
        keys = [F.col(f"`{c}`") for c in by]
        hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not has_map(f.dataType)]
        if salts == "auto":
            out = _spread(df, n, by, F.xxhash64(F.lit("row"), *hashed))
        else:
            if salts > 1:
                keys.append(F.pmod(F.xxhash64(*hashed), F.lit(salts)))
            out = df.repartition(n, *keys) if n else df.repartition(*keys)
    elif how == "range":
        if not by:
            raise ValueError("range layout needs columns")
        out = df.repartitionByRange(n, *by) if n else df.repartitionByRange(*by)
    elif how == "coalesce":
        out = df.coalesce(n)
    elif how == "none":
        out = df
    else:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    return out


def _key_hash(by: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in by])


def hot_keys(df: DataFrame, by: Sequence[str], share: float) -> tuple[int, dict[int, int]]:
    """The rows of ``df``, and the keys (by hash) that hold more than
    ``share`` of them, with about their rows: a frequent-items sketch of the
    key columns, merged from the tasks' sketches, whose error is under a tenth
    of the share, so no key over it is missed. A share too small for the sketch
    is found by counting the keys. At most ``1 / share`` keys reach the driver."""
    keys = df.select(_key_hash(by).alias("item"))
    top = math.ceil(2 / share)
    if 40 * top > SKETCH_ITEMS:
        rows = keys.count()
        counted = keys.groupBy("item").count().filter(F.col("count") > share * rows)
        return rows, {r["item"]: r["count"] for r in counted.toLocalIterator()}
    found = keys.agg(F.count(F.lit(1)).alias("rows"),
                     F.expr(f"approx_top_k(item, {top}, {40 * top})").alias("top")).first()
    rows = found["rows"]
    return rows, {r["item"]: r["count"] for r in found["top"] or () if r["count"] > share * rows}


def _spread(df: DataFrame, n: int | None, by: Sequence[str], row_hash: Column) -> DataFrame:
    """Hash partitions, hot keys dealt over neighbouring ones."""
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # keys of half a partition and more are dealt, so that none makes one twice the mean
    rows, hot = hot_keys(df, by, 1 / (2 * n))
    home = F.pmod(_key_hash(by), F.lit(n))
    if not hot:
        return df.repartitionById(n, home.cast("int"))
    parts = spark.createDataFrame([(k, min(n, math.ceil(2 * c * n / rows))) for k, c in hot.items()],
                                  "__hot long, __parts int")  # 2n rows at most
    dealt = df.withColumn("__row", row_hash).join(F.broadcast(parts), _key_hash(by) == F.col("__hot"),
                                                  "left")
    at = F.pmod(home + F.coalesce(F.pmod("__row", "__parts"), F.lit(0)), F.lit(n))
    return dealt.repartitionById(n, at.cast("int")).drop("__row", "__hot", "__parts")


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition: (partition_id, rows). Partitions with no rows are absent."""
    return (df.select(F.spark_partition_id().alias("partition_id"))
            .groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows")))


def range_profile(df: DataFrame, key: str) -> DataFrame:
    """Per partition: rows and the smallest and largest key (checks range layouts)."""
    return (df.select(F.spark_partition_id().alias("partition_id"), F.col(key).alias("k"))
            .groupBy("partition_id")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("k").alias("min_key"),
                 F.max("k").alias("max_key")))


def write_laid_out(df: DataFrame, path: str, how: str = "none", n: int | None = None,
                   by: Sequence[str] = (), sort_within: Sequence[str] = (),
                   partition_by: Sequence[str] = (), mode: str = "errorifexists",
                   fmt: str = "parquet") -> None:
    """Lay the rows out, then write them (one file per non-empty partition,
    times the directory partitions of ``partition_by``)."""
    w = lay_out(df, how, n, by, sort_within).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
