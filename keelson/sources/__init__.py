"""Sources and sinks: guarded CSV ingestion, schema contracts, tables and
snapshots, incremental batches."""

from keelson.sources.csv_ingest import (all_columns_guard, conform, enforce, ingest_csv,
                                        read_csv, read_ingested, split_quarantine, stage_parsed)
from keelson.sources.incremental import high_water_mark, new_rows
from keelson.sources.partitioned import TouchedPartitions, merge_partitions
from keelson.sources.tables import (latest_version, publish_dimension, read_dimension,
                                    read_snapshot, read_table, read_versions, save_table, sql_over,
                                    write_snapshot)

__all__ = [
    "TouchedPartitions", "merge_partitions", "all_columns_guard", "conform", "enforce", "ingest_csv", "read_ingested", "high_water_mark", "latest_version",
    "new_rows", "publish_dimension", "read_csv", "read_dimension", "read_snapshot", "read_table", "read_versions", "save_table",
    "split_quarantine", "sql_over", "stage_parsed", "write_snapshot",
]
