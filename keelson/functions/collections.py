"""Array and map helpers with NULL-safe, deterministic behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_to_array(c: str | Column, pattern: str = ",") -> Column:
    """Split text on a regular expression into array<string>."""
    return F.split(_c(c), pattern)


def zip_arrays(*cols: str | Column) -> Column:
    """Position-wise zip into array<struct>; the shorter array is padded with NULL."""
    return F.arrays_zip(*[_c(c) for c in cols])


def zip_to_map(keys: str | Column, values: str | Column, dedup: str = "last") -> Column:
    """Two parallel arrays to a map (``map_from_entries(arrays_zip(k, v))``).

    Spark raises on a NULL key and, by default, on a repeated key. Here
    entries with a NULL key are dropped, and a repeated key keeps its
    ``"last"`` (default) or ``"first"`` value; ``"error"`` keeps Spark's
    behaviour. Work per row is O(n log n) in the array length.
    """
    if dedup not in ("first", "last", "error"):
        raise ValueError(f"dedup must be 'first', 'last' or 'error', not {dedup!r}")
    k, v = _c(keys), _c(values)
    n = F.greatest(F.size(k), F.size(v))
    pos = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    entries = F.transform(pos, lambda i: F.struct(
        F.try_element_at(k, i).alias("k"), i.alias("i"), F.try_element_at(v, i).alias("v")))
    entries = F.filter(entries, lambda e: e["k"].isNotNull() & (e["i"] <= F.size(k)))
    if dedup == "error":
        return F.map_from_arrays(F.transform(entries, lambda e: e["k"]),
                                 F.transform(entries, lambda e: e["v"]))
    ordered = F.array_sort(entries)  # by key, then position
    m = F.size(ordered)
    if dedup == "last":
        keep = F.filter(ordered, lambda e, j: (j + 1 == m)
                        | ~F.coalesce(F.try_element_at(ordered, j + 2)["k"] == e["k"], F.lit(False)))
    else:
        keep = F.filter(ordered, lambda e, j: (j == 0)
                        | ~F.coalesce(F.try_element_at(ordered, F.greatest(j, F.lit(1)))["k"] == e["k"], F.lit(False)))
    return F.map_from_arrays(F.transform(keep, lambda e: e["k"]),
                             F.transform(keep, lambda e: e["v"]))


def sorted_map_keys(c: str | Column) -> Column:
    return F.array_sort(F.map_keys(_c(c)))


def sorted_map_values(c: str | Column) -> Column:
    return F.array_sort(F.map_values(_c(c)))
