"""Incremental loads as a Structured Streaming query.

Daily batches land as files in a folder; a file-source stream picks up new
files, and ``foreachBatch`` applies each micro-batch to the dimension with
``scd2`` (or any other step) and publishes the next snapshot
(``sources.tables.write_snapshot``). Each epoch reads the previous snapshot
back from storage, so lineage never grows across batches.

A micro-batch may hold several days' files (a stream that was down for a
while): it is staged once, partitioned by ``as_of_col``, and applied one value
after the other, each from its own folder, so every file is read once however
many days it holds, and the result doesn't depend on when the stream runs.
Each step becomes a version of its own.

Re-runs are safe: the stream's checkpoint records which files were
processed, each step writes a folder of its own which counts once it is
committed, and with hash change detection applying the same step twice
changes nothing, so an epoch replayed after a crash between commit and
checkpoint leaves the dimension as it was. Rows without an ``as_of_col``
value can't be placed in time and are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.merging import dedupe_latest
from keelson.session import stage_parquet
from keelson.sources.tables import (latest_version, publish_dimension, read_dimension,
                                    read_snapshot, write_snapshot)

#: The folder column of a staged micro-batch.
DAY = "__day"


def stream_apply(spark: SparkSession, batch_dir: str, batch_schema: T.StructType | str,
                 snapshot_base: str, step: Callable[[DataFrame, DataFrame, str], DataFrame], *,
                 keys: Sequence[str], as_of_col: str, checkpoint: str,
                 order_by: Sequence[str] | None = None, fmt: str = "parquet",
                 available_now: bool = True, layout: str = "snapshot",
                 flag_col: str = "cur_rec_ind"):
    """Start a stream that applies every new batch file to the snapshot.

    ``step(current, batch, as_of)`` returns the next snapshot; ``as_of`` is
    the ``as_of_col`` value of the rows (their own processing date, not the
    clock). Several rows of one key and one value are reduced to the latest by
    ``order_by`` (default: ``as_of_col``; ties by the rows' hash).
    Returns the StreamingQuery (``available_now`` processes what is there,
    then stops).

    ``layout="snapshot"``: every epoch writes the whole next table
    (``write_snapshot``). ``layout="dimension"``: the type-2 store
    (``publish_dimension``): ``step`` gets only the current rows and the
    epoch writes current rows plus the rows it closed, so the cost of an
    epoch does not grow with the history.
    """
    if layout not in ("snapshot", "dimension"):
        raise ValueError("layout must be 'snapshot' or 'dimension'")
    stream = spark.readStream.schema(batch_schema).format(fmt).load(batch_dir)
    order = list(order_by) if order_by else [as_of_col]

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # NULL has a folder too; dates and moments are text there, in an order of their own
        staged = stage_parquet(batch.withColumn(DAY, F.concat(F.lit("d"), F.col(as_of_col).cast(
            "string"))), "micro-batch", partition_by=DAY)
        found = [r[DAY] for r in staged.select(DAY).distinct().collect()]
        if None in found:
            raise ValueError(f"rows without {as_of_col}")
        for moment in sorted(d[1:] for d in found):
            latest = latest_version(spark, snapshot_base)
            if latest is None:
                raise FileNotFoundError(f"no committed snapshot under {snapshot_base}: "
                                        f"publish the full load first")
            rows = staged.filter(F.col(DAY) == f"d{moment}").drop(DAY)
            changes = dedupe_latest(rows, keys, order).drop(as_of_col)
            if layout == "dimension":
                current = read_dimension(spark, snapshot_base, latest[0], current_only=True)
                publish_dimension(step(current, changes, moment), snapshot_base, latest[0] + 1,
                                  flag_col=flag_col)
            else:
                write_snapshot(step(read_snapshot(spark, snapshot_base), changes, moment),
                               snapshot_base, latest[0] + 1)

    writer = (stream.writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
