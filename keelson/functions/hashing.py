"""Key and row fingerprints (md5 surrogate keys, change-detection hashes).

All of these are built-in Column expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed encoding of the fingerprint (changing any of these changes every hash):
#   fields are joined with "|"; a non-NULL field is written "<length>:<text>";
#   a NULL field is written "~"; floating point values as their shortest text
#   that reads back as the same value (-0.0 as 0.0; NaN and the infinities have
#   texts of their own, which differ from NULL); timestamps (instants) as epoch
#   microseconds, so that it does not depend on the session time zone; binary
#   values as hex. Nested values are built of fields written the same way: arrays
#   as "[a|b]", structs as "(a|b)", maps as "{k=v|k=v}" sorted by the text of
#   the entries.
FIELD_SEPARATOR = "|"
NULL_FIELD = "~"


def md5_key(*cols: str | Column, types: Sequence[T.DataType] | None = None) -> Column:
    """md5 of one or more key columns, each as text.

    One column gives ``md5(cast(c as string))``, the surrogate key used for a
    "hash key" join. Several columns are encoded like ``row_hash`` so that
    ("ab", "c") and ("a", "bc") get different keys. ``types`` (a type for each
    column) casts the columns first and gives each value its one text: 0.0 and
    -0.0 are alike, and moments don't follow the session time zone.
    """
    given = [_col(c) for c in cols]
    if types is not None:
        given = [c.cast(t) for c, t in zip(given, types, strict=True)]
    kinds = types or [None] * len(given)
    if len(given) == 1:
        return F.md5(_as_text(given[0], kinds[0]))
    return F.md5(F.concat_ws(FIELD_SEPARATOR, *map(_as_field, given, kinds)))


def row_hash(cols: Iterable[str | Column], schema: T.StructType | None = None,
             compat: bool = False, cast_to: dict[str, T.DataType] | None = None) -> Column:
    """A change-detection fingerprint of a row's tracked columns.

    The default encoding marks NULLs and prefixes every field with its length,
    so no two different rows share the text that is hashed. ``compat=True``
    gives the plain ``md5(concat_ws('_', ...))`` form, which skips NULLs and
    therefore makes (1, NULL, '3') and (1, '3', NULL) collide; it exists only
    to read hashes written that way.

    ``schema`` tells the types of columns named by string (floating point,
    moments, binary and nested values have texts of their own); pass
    ``df.schema`` (``hash_columns`` does it for you). ``cast_to`` maps
    column names to the type they are hashed as (so that a batch whose
    columns arrive as text hashes like the typed table it is compared with).
    """
    cols = list(cols)
    types = {f.name.lower(): f.dataType for f in schema.fields} if schema else {}
    casts = {k.lower(): v for k, v in (cast_to or {}).items()}
    parts = []
    for c in cols:
        col, dtype = _col(c), None
        if isinstance(c, str):
            dtype = casts.get(c.lower(), types.get(c.lower()))
            if c.lower() in casts:
                col = col.cast(dtype)
        if compat:
            parts.append(col.cast("string"))
            continue
        parts.append(_as_field(col, dtype))
    return F.md5(F.concat_ws("_" if compat else FIELD_SEPARATOR, *parts))


def hash_columns(df: DataFrame, cols: Iterable[str], name: str = "hash_key",
                 compat: bool = False) -> DataFrame:
    """Add (or replace) a fingerprint column over ``cols``."""
    return df.withColumn(name, row_hash(list(cols), df.schema, compat=compat))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_field(c: Column, dtype: T.DataType | None) -> Column:
    text = _as_text(c, dtype)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_FIELD))


def _as_text(c: Column, dtype: T.DataType | None) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0).cast(dtype)).cast("string")  # -0.0 + 0.0 is 0.0
    if isinstance(dtype, T.TimestampType):
        # an instant: its text would follow the session time zone
        return F.unix_micros(c).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(c)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda x: _as_field(x, dtype.elementType))
        return F.concat(F.lit("["), F.array_join(items, FIELD_SEPARATOR), F.lit("]"))
    if isinstance(dtype, T.StructType):
        fields = [_as_field(c.getField(f.name), f.dataType) for f in dtype.fields]
        return F.when(c.isNotNull(), F.concat(
            F.lit("("), F.concat_ws(FIELD_SEPARATOR, *fields), F.lit(")")))
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(
            _as_field(e["key"], dtype.keyType), F.lit("="), _as_field(e["value"], dtype.valueType)))
        return F.concat(F.lit("{"), F.array_join(F.array_sort(entries), FIELD_SEPARATOR), F.lit("}"))
    return c.cast("string")
