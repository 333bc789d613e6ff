"""DataFrame -> DataFrame operators."""

from keelson.operators.aggregate import (collect_chunks, collect_values, distinct_values, grouped,
                                         pivot, unpivot, value_counts)
from keelson.operators.joins import hash_key_join, join_aggregate, join_on, semi_join
from keelson.operators.layout import (hot_keys, lay_out, partition_profile, range_profile,
                                      with_partition_id, write_laid_out)
from keelson.operators.merging import (append_rows, check_source_keys, dedupe_latest,
                                     insert_new, insert_rows, merge, src, tgt)
from keelson.operators.ordering import sort_by, top_n
from keelson.operators.projection import (add_column, cast_columns, compare, derive_first,
                                          label_by, null_profile, rename_columns,
                                          replace_column, scale_columns)
from keelson.operators.scd import current, history, scd1, scd2, scd2_init, scd3, update_where
from keelson.operators.setops import union_all, union_by_name

__all__ = [
    "add_column", "append_rows", "cast_columns", "check_source_keys", "collect_chunks", "collect_values",
    "compare", "current", "dedupe_latest", "derive_first", "distinct_values", "grouped",
    "hash_key_join", "history", "hot_keys", "insert_new", "insert_rows", "join_aggregate", "join_on", "label_by",
    "lay_out", "merge", "null_profile", "partition_profile", "pivot", "range_profile",
    "rename_columns", "replace_column", "scale_columns", "scd1", "scd2", "scd2_init", "scd3",
    "semi_join", "sort_by", "src", "tgt", "top_n", "union_all", "union_by_name", "unpivot",
    "update_where", "value_counts", "with_partition_id", "write_laid_out",
]
