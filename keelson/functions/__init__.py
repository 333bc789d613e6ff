"""Column functions: keys and fingerprints, dates, arrays and maps, user functions."""

from keelson.functions.collections import (sorted_map_keys, sorted_map_values,
                                           split_to_array, zip_arrays, zip_to_map)
from keelson.functions.dates import (add_days, add_months, as_of_date, as_of_time, days_between,
                                     format_date, month_of, months_between, parse_date)
from keelson.functions.hashing import hash_columns, md5_key, row_hash

__all__ = [
    "add_days", "add_months", "as_of_date", "as_of_time", "days_between", "format_date",
    "hash_columns", "md5_key", "month_of", "months_between", "parse_date",
    "row_hash", "sorted_map_keys", "sorted_map_values", "split_to_array",
    "zip_arrays", "zip_to_map",
]
