"""Named tables, snapshots and SQL views.

Merges in this library return the next snapshot as a plan. Publishing it
is a write to a new folder followed by a one-row commit record that names
it; a reader takes the folder of the highest committed version. Every write
takes a folder of its own, so a run that fails before its commit record
leaves nothing visible and can simply be tried again, and nothing being read
is ever overwritten. A version that is committed can't be written again.

A table has one writer at a time: a Parquet folder offers no way to create a
record only if there is none. Two writers that commit one version at the same
time are noticed, not reconciled: after its commit each reads the records of
its version back, and raises if there are two; readers raise on them too,
until one of the two records is removed.
"""

from __future__ import annotations

import uuid
from itertools import pairwise

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", fmt: str = "parquet",
               merge_schema: bool = False, buckets: tuple[int, list[str]] | None = None,
               sort_by: list[str] | None = None) -> None:
    """``saveAsTable``: ``errorifexists`` (create, fail if present),
    ``overwrite`` or ``append``. ``merge_schema`` lets an append bring columns
    that the table lacks: they are added to the table first (``ALTER TABLE``),
    and read as NULL in its older rows; columns that the rows lack are NULL.

    ``buckets=(n, keys)`` stores the table hash-bucketed on its keys: a later
    join or merge on those keys reads it already partitioned, so only the
    other side is shuffled (to ``n`` partitions). For a dimension merged
    every day, bucket it by its business key.
    """
    spark = df.sparkSession
    if merge_schema and mode == "append" and spark.catalog.tableExists(name):
        df = _widened(spark, df, name)
    w = df.write.mode(mode).format(fmt)
    if buckets is not None:
        n, keys = buckets
        w = w.bucketBy(n, *keys)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(name)


def _widened(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Add ``df``'s new columns to the table; ``df`` in the table's columns."""
    have = {f.name.lower() for f in spark.table(name).schema.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    mine = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{mine[f.name.lower()]}`") if f.name.lower() in mine else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in spark.table(name).schema.fields])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def sql_over(spark: SparkSession, views: dict[str, DataFrame], query: str) -> DataFrame:
    """Run SQL over DataFrames by name. A name is a named plan, nothing is
    materialised, and it is gone afterwards: a temp view of the caller's that
    has the same name is as it was."""
    before = {v.name.lower(): spark.table(v.name) for v in spark.catalog.listTables()
              if v.isTemporary and v.name.lower() in {n.lower() for n in views}}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(query)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
            if name.lower() in before:
                before[name.lower()].createOrReplaceTempView(name)


def _commits(spark: SparkSession, base: str) -> DataFrame | None:
    """The commit records (version, path, committed_at), or None before the
    first. Any other trouble in reading them is the caller's to see."""
    try:
        return spark.read.schema("version long, path string, committed_at timestamp").parquet(
            f"{base.rstrip('/')}/{COMMITS}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _refuse_committed(spark: SparkSession, base: str, version: int) -> None:
    commits = _commits(spark, base)
    if commits is not None and not commits.filter(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version} under {base} is committed already")


def _commit(spark: SparkSession, base: str, version: int, path: str) -> None:
    (spark.createDataFrame([(version, path)], "version long, path string")
     .withColumn("committed_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/{COMMITS}"))
    _one_record(base, _commits(spark, base).filter(F.col("version") == version))


def _one_record(base: str, records: DataFrame) -> tuple[int, str] | None:
    """(version, path) of the only record, or None; two of them raise."""
    found = records.select("version", "path").limit(2).collect()
    if len(found) > 1:
        raise RuntimeError(f"two writers committed version {found[0]['version']} under {base}: "
                           f"{sorted(r['path'] for r in found)}; remove one of the records")
    return (found[0]["version"], found[0]["path"]) if found else None


def write_snapshot(df: DataFrame, base: str, version: int) -> str:
    """Write ``df`` as version ``version`` under ``base`` and commit it. A
    write that failed may be tried again; a committed version is refused."""
    spark = df.sparkSession
    _refuse_committed(spark, base, version)
    path = f"{base.rstrip('/')}/v={version:010d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(path)
    _commit(spark, base, version, path)
    return path


def latest_version(spark: SparkSession, base: str) -> tuple[int, str] | None:
    """(version, path) of the newest committed snapshot, or None."""
    return _committed(spark, base, None)


def _committed(spark: SparkSession, base: str, version: int | None) -> tuple[int, str] | None:
    commits = _commits(spark, base)
    if commits is None:
        return None
    if version is None:
        version = commits.agg(F.max("version")).first()[0]
    return None if version is None else _one_record(base, commits.filter(F.col("version") == version))


def read_snapshot(spark: SparkSession, base: str, version: int | None = None,
                  merge_schema: bool = False) -> DataFrame:
    """The latest (or a given) committed snapshot. ``merge_schema`` reads a
    snapshot written with a wider schema than older files."""
    found = _committed(spark, base, version)
    if found is None:
        raise FileNotFoundError(f"no committed snapshot{'' if version is None else f' {version}'} "
                                f"under {base}")
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(found[1])


def read_versions(spark: SparkSession, paths: list[str], merge_schema: bool = True) -> DataFrame:
    """Several parquet versions as one DataFrame; with ``merge_schema`` a
    column missing from older files reads as NULL there."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


# ---------------------------------------------------------------------------
# type-2 dimension store: history is written once, never rewritten

RUNS = "runs"
#: Partition columns of the store; a dimension can't have columns of these names.
RUN_PART, CURRENT_PART = "__run", "__is_current"


def publish_dimension(df: DataFrame, base: str, version: int, flag_col: str = "cur_rec_ind",
                      current_flag: str = "Y") -> str:
    """Write one run of a type-2 dimension and commit it.

    ``df`` holds the run's current rows and the rows it closed (what
    ``scd2`` returns when its target is only the current rows). One write,
    partitioned by currency: ``runs/__run=<id>/__is_current=true|false``.
    The current rows of the newest committed run are the current table;
    the closed rows of every committed run together are the history. A run
    therefore writes (current + newly closed) rows, never the history that
    came before. A run that failed is a folder that no commit names: readers
    pass it over, and the next attempt writes another. A committed version
    is refused.
    """
    taken = {RUN_PART, CURRENT_PART} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"column names reserved for the store: {sorted(taken)}")
    spark, root = df.sparkSession, base.rstrip("/")
    _refuse_committed(spark, root, version)
    path = f"{root}/{RUNS}/{RUN_PART}={version:010d}-{uuid.uuid4().hex[:8]}"
    is_cur = F.coalesce(F.col(flag_col) == F.lit(current_flag), F.lit(False))
    df.withColumn(CURRENT_PART, is_cur).write.mode("errorifexists").partitionBy(
        CURRENT_PART).parquet(path)
    _commit(spark, root, version, path)
    return path


def read_dimension(spark: SparkSession, base: str, version: int | None = None,
                   current_only: bool = False) -> DataFrame:
    """The dimension as of a committed run (default: the newest).

    Only folders that commit records name are read: the newest run's current
    rows, and the closed rows of it and the runs before. Both choices are of
    whole folders; ``current_only`` reads one. The runs' names (one short
    text each) are what reaches the driver.
    """
    root = base.rstrip("/")
    newest = _committed(spark, root, version)
    if newest is None:
        raise FileNotFoundError(f"no committed run{'' if version is None else f' {version}'} "
                                f"under {root}")
    paths = [newest[1]]
    if not current_only:
        earlier = _commits(spark, root).filter(F.col("version") < newest[0])
        found = earlier.orderBy("version").collect()
        twice = [a["version"] for a, b in pairwise(found) if a["version"] == b["version"]]
        if twice:
            raise RuntimeError(f"two writers committed versions {twice} under {root}")
        paths += [r["path"] for r in found]
    runs = spark.read.option("basePath", f"{root}/{RUNS}").parquet(*paths)
    # a run's id may look like a number or not: compare as text
    latest = F.col(RUN_PART).cast("string") == newest[1].rpartition(f"{RUN_PART}=")[2]
    keep = latest & F.col(CURRENT_PART)
    return runs.filter(keep if current_only else keep | ~F.col(CURRENT_PART)).drop(
        RUN_PART, CURRENT_PART)
