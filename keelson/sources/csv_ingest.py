"""CSV ingestion with an explicit schema contract and bad-record handling.

The trap this module closes: Spark's CSV reader converts (and so judges) a
field only when the query needs its column. Under column pruning,
``DROPMALFORMED`` + ``count()`` drops nothing, ``FAILFAST`` + ``count()``
does not fail, and a one-column select over a quarantine read calls bad rows
good. Every mode here except ``"null"`` adds a filter that needs every
column (the count of NULL fields is ``>= 0``); it is always true, but the
optimizer cannot remove it, so the parser converts every field
of every row whatever the rest of the query asks for.

Modes (``on_bad``):
- ``"null"``: keep every row, an unparsable field becomes NULL (PERMISSIVE);
- ``"quarantine"``: keep every row plus the raw line of bad rows in
  ``corrupt_col``; ``split_quarantine`` separates good rows and bad lines;
- ``"drop"``: drop bad rows (DROPMALFORMED, guarded);
- ``"fail"``: the first bad row fails the job (FAILFAST, guarded).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = {"null": "PERMISSIVE", "quarantine": "PERMISSIVE", "drop": "DROPMALFORMED",
         "fail": "FAILFAST"}
CORRUPT_COL = "_corrupt_record"


def _schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)


def all_columns_guard(cols) -> Column:
    """An always-true predicate that needs every column of ``cols``: the
    number of NULL fields is never negative, but the optimizer does not know
    that, so it keeps the predicate and the scan must parse every column.
    Integer arithmetic only, no per-row text building."""
    flags = [F.col(f"`{c}`").isNull().cast("int") for c in cols]
    total = flags[0]
    for f in flags[1:]:
        total = total + f
    return total >= 0


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, *,
             header: bool = False, infer_schema: bool = False, on_bad: str = "quarantine",
             corrupt_col: str = CORRUPT_COL, sep: str = ",",
             options: Mapping[str, str] | None = None) -> DataFrame:
    """Read CSV files.

    With no ``schema`` and no ``infer_schema`` every column is text (header
    names, or ``_c0``...). ``infer_schema`` costs an extra pass over the data
    and turns a column with one bad value into text; an explicit schema is
    the contract to use in production. Under ``on_bad="quarantine"`` the
    schema so found (from the first line, or by inference) is the one that
    lines are held to.
    """
    if on_bad not in MODES:
        raise ValueError(f"on_bad must be one of {sorted(MODES)}")
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("mode", MODES[on_bad]))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema is None and on_bad == "quarantine":
        schema = reader.option("inferSchema", infer_schema).csv(path).schema
    if schema is None:
        df = reader.option("inferSchema", infer_schema).csv(path)
        data_cols = df.columns
    else:
        st = _schema(schema)
        data_cols = [f.name for f in st.fields if f.name != corrupt_col]
        if on_bad == "quarantine":
            fields = [f for f in st.fields if f.name != corrupt_col]
            st = T.StructType(fields + [T.StructField(corrupt_col, T.StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        df = reader.schema(st).csv(path)
    if on_bad == "null":
        return df
    return df.filter(all_columns_guard(data_cols))


def split_quarantine(df: DataFrame, corrupt_col: str = CORRUPT_COL,
                     raw_name: str = "raw_line") -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows as their raw line).

    Each side rescans its input; stage ``df`` first (``stage_parsed``) when
    the CSV is large and both sides are needed.
    """
    good = df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.filter(F.col(corrupt_col).isNotNull()).select(F.col(corrupt_col).alias(raw_name))
    return good, bad


def stage_parsed(df: DataFrame, path: str) -> DataFrame:
    """Write a parsed (guarded) read to parquet once and read it back, so the
    CSV is parsed once however many times the result is used."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


# ---------------------------------------------------------------------------
# schema contract on any DataFrame (A8)

VIOLATIONS_COL = "_violations"


def _may_lose(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether a cast between two number types can change a value."""
    return (isinstance(given, T.NumericType) and isinstance(wanted, T.NumericType)
            and given != wanted)


def conform(df: DataFrame, schema: T.StructType | str, violations_col: str = VIOLATIONS_COL) -> DataFrame:
    """Cast ``df`` to ``schema`` and list, per row, the columns that break it.

    A column breaks the contract when a non-NULL value does not convert
    (``try_cast`` gives NULL), when a number loses part of its value in the
    cast (1.9 as an int), or when a non-nullable field is NULL. The
    result has the schema's columns plus ``violations_col`` (array of
    column names, empty when the row is good). Columns of ``df`` that the
    schema lacks are dropped; schema columns that ``df`` lacks are NULL.
    """
    st = _schema(schema)
    have = {c.lower(): c for c in df.columns}
    cols, checks = [], []
    for f in st.fields:
        src = have.get(f.name.lower())
        raw = F.col(f"`{src}`") if src else F.lit(None)
        typed = raw.try_cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(typed.alias(f.name))
        bad = raw.isNotNull() & typed.isNull() if src else F.lit(False)
        if src and _may_lose(df.schema[src].dataType, f.dataType):
            bad = bad | F.coalesce(typed.try_cast(df.schema[src].dataType) != raw, F.lit(False))
        if not f.nullable:
            bad = bad | typed.isNull()
        checks.append(F.when(bad, F.lit(f.name)))
    return df.select(*cols, F.filter(F.array(*checks), lambda x: x.isNotNull()).alias(violations_col))


def enforce(df: DataFrame, schema: T.StructType | str, on_violation: str = "quarantine",
            violations_col: str = VIOLATIONS_COL):
    """Apply ``conform`` and act on violations.

    - ``"quarantine"``: returns (good, bad); bad keeps ``violations_col``;
    - ``"drop"``: returns the good rows;
    - ``"fail"``: returns the good rows, and the job fails at the first bad
      row (lazily, through ``assert_true``: no extra pass).
    Good rows hold no NULL in a non-nullable field (their schema still calls
    it nullable: no public expression can tell Spark otherwise).
    """
    st = _schema(schema)
    c = conform(df, st, violations_col)
    ok = F.size(F.col(violations_col)) == 0
    if on_violation == "quarantine":
        return c.filter(ok).drop(violations_col), c.filter(~ok)
    if on_violation == "drop":
        return c.filter(ok).drop(violations_col)
    if on_violation == "fail":
        checked = c.filter(F.coalesce(
            F.assert_true(ok, F.concat(F.lit("schema contract broken in columns "),
                                       F.array_join(F.col(violations_col), ","))).isNull(),
            F.lit(True)))
        return checked.drop(violations_col)
    raise ValueError("on_violation must be 'quarantine', 'drop' or 'fail'")


# ---------------------------------------------------------------------------
# parse once, write both sides

QUARANTINE_PART = "quarantined"


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType | str, dest: str, *,
               header: bool = False, corrupt_col: str = CORRUPT_COL,
               options: Mapping[str, str] | None = None) -> str:
    """Parse a CSV feed once and write good rows and bad lines in one job.

    The guarded quarantine read is written partitioned by
    ``quarantined=false|true``: good rows land typed in one folder, bad rows
    (with their raw line in ``corrupt_col``) in the other. However large the
    feed, it is parsed exactly once; ``read_ingested`` reads either side
    with partition pruning.
    """
    df = read_csv(spark, path, schema, header=header, on_bad="quarantine",
                  corrupt_col=corrupt_col, options=options)
    (df.withColumn(QUARANTINE_PART, F.col(corrupt_col).isNotNull())
       .write.mode("errorifexists").partitionBy(QUARANTINE_PART).parquet(dest))
    return dest


def read_ingested(spark: SparkSession, dest: str, bad: bool = False,
                  corrupt_col: str = CORRUPT_COL, raw_name: str = "raw_line") -> DataFrame:
    """The good rows (without the corrupt column) or the bad lines of an
    ``ingest_csv`` output; only that side's folder is read."""
    df = spark.read.parquet(dest).filter(F.col(QUARANTINE_PART) == F.lit(bad))
    if bad:
        return df.select(F.col(corrupt_col).alias(raw_name))
    return df.drop(corrupt_col, QUARANTINE_PART)
