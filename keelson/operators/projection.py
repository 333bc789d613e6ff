"""Projection, predicates and conditionals (checked wrappers over select/filter).

The wrappers add the checks Spark leaves out: duplicate or absent names,
case-insensitive replacement, explicit numeric casts before comparisons.
All of them produce a single Project/Filter node that Catalyst merges with
its neighbours and pushes into the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _names(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def resolve(df: DataFrame, name: str) -> str:
    """The actual column name for ``name`` (case-insensitive); KeyError if absent."""
    found = _names(df).get(name.lower())
    if found is None:
        raise KeyError(f"no column {name!r} in {df.columns}")
    return found


def derive_first(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``select(expr.alias(name), "*")``, refusing a name already present.

    Spark would silently produce two columns with the same name.
    """
    if name.lower() in _names(df):
        raise ValueError(f"column {name!r} already exists; use replace_column")
    return df.select(expr.alias(name), "*")


def add_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add a computed column; refuses to overwrite an existing one."""
    if name.lower() in _names(df):
        raise ValueError(f"column {name!r} already exists; use replace_column")
    return df.withColumn(name, expr)


def replace_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Replace an existing column in place, matched case-insensitively.

    The column keeps its position and takes the spelling given in ``name``.
    """
    old = resolve(df, name)
    return df.select(*[expr.alias(name) if c == old else F.col(c) for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Rename several columns in one projection; absent names raise when ``strict``."""
    actual = {}
    for old, new in mapping.items():
        try:
            actual[resolve(df, old)] = new
        except KeyError:
            if strict:
                raise
    out = [actual.get(c, c) for c in df.columns]
    if len({c.lower() for c in out}) != len(out):
        raise ValueError(f"renaming gives duplicate names: {out}")
    return df.select(*[F.col(c).alias(actual.get(c, c)) for c in df.columns])


_OPS = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


def compare(c: str | Column, op: str, value, as_type: str | T.DataType | None = None) -> Column:
    """A comparison predicate with an explicit cast of the column first.

    On a text column (an untyped CSV, say) ``col > 40`` lets ANSI mode cast the
    text to BIGINT and fail on '72.5'; ``as_type="double"`` makes the intended
    numeric comparison, with unparsable text compared as NULL (row dropped).
    """
    col = F.col(c) if isinstance(c, str) else c
    if as_type is not None:
        col = col.try_cast(as_type)
    return _OPS[op](col, F.lit(value))


def all_of(*preds: Column) -> Column:
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def label_by(conditions: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """Multi-way conditional: the first true condition wins, NULL counts as false."""
    expr = None
    for cond, value in conditions:
        val = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType], strict: bool = False) -> DataFrame:
    """Cast named columns; bad values become NULL unless ``strict`` (then they raise)."""
    want = {resolve(df, k): v for k, v in types.items()}
    return df.select(*[
        (F.col(c).cast(want[c]) if strict else F.col(c).try_cast(want[c])).alias(c)
        if c in want else F.col(c) for c in df.columns])


def scale_columns(df: DataFrame, cols: Iterable[str], factor, keep: Iterable[str] = (),
                  as_type: str | T.DataType | None = None) -> DataFrame:
    """Multiply numeric columns by ``factor`` (the row-map "x * 2" as an expression).

    Text columns must be given an ``as_type``: multiplying text repeats it in
    Python, and ANSI-casts it in Spark.
    """
    keep = list(keep)
    out = [F.col(resolve(df, k)) for k in keep]
    for c in cols:
        src = F.col(resolve(df, c))
        if as_type is not None:
            src = src.try_cast(as_type)
        out.append((src * F.lit(factor)).alias(c))
    return df.select(*out)


def null_profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL count per column, one row, one pass (partial aggregation per task)."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
