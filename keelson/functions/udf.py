"""User functions: Arrow-batched, NULL-safe wrappers.

Built-in expressions are always preferred (``format_date`` gives the same
text as ``month_year_label`` inside codegen). This module exists for logic a
user really has to write in Python; it wraps the function so that it is
called on whole pandas batches and never sees a NULL.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def vectorized(fn: Callable[[pd.Series], pd.Series], return_type: T.DataType | str):
    """Turn a function of a pandas Series into a NULL-safe pandas UDF.

    ``fn`` gets the non-NULL values of each Arrow batch as one Series and
    returns a Series of the same length; NULL in gives NULL out.
    """

    @F.pandas_udf(return_type)
    def _apply(s: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(s), index=s.index, dtype=object)
        mask = s.notna()
        if mask.any():
            out[mask] = fn(s[mask])
        return out

    return _apply


def each_value(fn: Callable) -> Callable[[pd.Series], pd.Series]:
    """A function of one value as a function of a Series, for ``vectorized``
    (per-value Python: for logic that has no batch form)."""
    return lambda s: s.map(fn)


def register_udf(spark: SparkSession, name: str, fn: Callable,
                 return_type: T.DataType | str):
    """Register ``fn`` (of a Series) for SQL under ``name`` (NULL-safe, Arrow-batched)."""
    wrapped = vectorized(fn, return_type)
    spark.udf.register(name, wrapped)
    return wrapped


def _month_year(d: pd.Series) -> pd.Series:
    return pd.to_datetime(d).dt.strftime("%b-%Y")


# date -> 'Nov-2022'; equals format_date(c, 'MMM-yyyy') in an English locale
month_year_label = vectorized(_month_year, T.StringType())
