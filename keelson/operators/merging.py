"""Keyed merge (upsert) over immutable snapshots.

Stock Spark file tables refuse ``MERGE``/``UPDATE``. Here a merge is a plan:
target snapshot + source batch in, next snapshot out; the caller writes it
to a new location (see ``keelson.sources.tables.write_snapshot``), so a
failed run never leaves a half-applied table. Building a plan runs no job
(only ``strategy="broadcast"`` probes the source's size).

Plan shape (``aligned_join``), the same at every size:

* target rows that cannot match (a NULL key, or failing ``target_filter``,
  e.g. history rows of an SCD 2 table) bypass the join and are unioned back
  unchanged: they are never shuffled;
* source keys are cast to the target's key types first, and the source is
  reduced to one row per key that carries the number of its rows. Each row
  that comes out of a join is filtered by that number, so a key with two rows
  raises while the plan runs, whatever is filtered, joined, selected or
  limited afterwards, as long as a row of that key comes out. (The reduction
  is dealt by a hash of the key, not by the key: Spark then deals its rows,
  one per key, to the join anew, and AQE splits a skewed partition of the
  target only where nothing stands between its exchange and the join.) A
  merge that leaves out one side's rows counts the keys in a branch that
  returns no rows, so that keys that don't come out are checked too;
* the eligible target rows are LEFT OUTER joined to the source. A left join
  (not a full one) lets AQE split the partition of a target key that holds
  many rows, and turn the join into a broadcast one when the source turns
  out small;
* source rows that match nothing are the source anti-joined with the
  target's distinct keys (a scan of the key columns, reduced in each map
  task), on the same exchange of the source;
* an update-only merge leaves the second part out, an insert-only merge the
  first: there the target's rows pass through without a join.

``strategy="broadcast"`` keeps the target from being shuffled at all if the
source, which is measured first (``plans.sizing.size_bound``), is within the
session's bounds; beyond them the plan is the same as ``"auto"``.
``"shuffle"`` asks for a sort-merge join whatever the sizes.

Side detection uses literal marker columns, never NULL tests on keys. The
source takes part in several branches, so it must give the same rows each
time it is evaluated: stage one that doesn't (``session.stage_parquet``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.plans.sizing import broadcast_limits, size_bound

T_PREFIX = "t__"
S_PREFIX = "s__"
T_MARK = "__t"
S_MARK = "__s"
S_ROWS = "__s_rows"

STRATEGIES = ("auto", "shuffle", "broadcast")
NULL_KEYS = ("fail", "insert")


def src(name: str) -> Column:
    """A source column inside merge expressions (``source.<name>``)."""
    return F.col(f"`{S_PREFIX}{name}`")


def tgt(name: str) -> Column:
    """A target column inside merge expressions (``target.<name>``)."""
    return F.col(f"`{T_PREFIX}{name}`")


# ---------------------------------------------------------------------------
# helpers

def key_pairs(on: str | Sequence[str] | Mapping[str, str]) -> list[tuple[str, str]]:
    """Normalise keys to (target name, source name) pairs."""
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def _field(df: DataFrame, name: str) -> T.StructField:
    for f in df.schema.fields:
        if f.name.lower() == name.lower():
            return f
    raise KeyError(f"no column {name!r} in {df.columns}")


def has_map(t: T.DataType) -> bool:
    """Whether a type is or holds a map (which can be neither hashed nor ordered)."""
    if isinstance(t, T.ArrayType):
        return has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType)


def _and(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in cols])


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")
_QUALIFIED = re.compile(r"\b(source|target)\.([A-Za-z_][A-Za-z0-9_]*)", re.IGNORECASE)


def resolve_expr(spec, target: DataFrame, source: DataFrame) -> Column:
    """A merge expression: a Column (use ``src``/``tgt``), ``"source.x"`` /
    ``"target.x"``, a bare column name found on exactly one side, another
    SQL expression, or a Python literal."""
    if isinstance(spec, Column):
        return spec
    if not isinstance(spec, str):
        return F.lit(spec)
    s = spec.strip()
    qualified = _QUALIFIED.fullmatch(s)
    if qualified:
        side, name = qualified.group(1).lower(), qualified.group(2)
        return src(_field(source, name).name) if side == "source" else tgt(_field(target, name).name)
    if _QUALIFIED.search(s):
        # an SQL expression over source.x / target.y: point the names at the
        # prefixed columns of the aligned join
        def repl(m):
            side, name = m.group(1).lower(), m.group(2)
            df, prefix = (source, S_PREFIX) if side == "source" else (target, T_PREFIX)
            return f"`{prefix}{_field(df, name).name}`"
        return F.expr(_QUALIFIED.sub(repl, s))
    if _IDENT.match(s):
        in_s = s.lower() in {c.lower() for c in source.columns}
        in_t = s.lower() in {c.lower() for c in target.columns}
        if in_s and in_t:
            raise ValueError(f"{s!r} is ambiguous: qualify it with source. or target.")
        if in_s:
            return src(_field(source, s).name)
        if in_t:
            return tgt(_field(target, s).name)
    return F.expr(s)


# ---------------------------------------------------------------------------
# source checks (I16)


@dataclass(frozen=True)
class SourceProfile:
    """What one pass over the source's key columns tells: its row count, the
    most rows that share a (non-NULL) key, and the rows with a NULL key."""
    rows: int
    max_rows_per_key: int
    null_key_rows: int
    worst_key: dict | None


def profile_source(source: DataFrame, keys: Sequence[str],
                   key_types: Mapping[str, T.DataType] | None = None) -> SourceProfile:
    """One aggregation job over the key columns only (a pruned scan): rows
    per key (partial counts per task, so a hot key is combined map-side),
    then one global row, which is all the driver receives. ``key_types``
    (key name -> type) profiles the keys as they are after that cast."""
    casts = {k.lower(): t for k, t in (key_types or {}).items()}
    kcols = [F.col(f"`{k}`").cast(casts[k.lower()]).alias(k) if k.lower() in casts
             else F.col(f"`{k}`") for k in keys]
    per_key = (source.select(*kcols).groupBy(*[F.col(f"`{k}`") for k in keys])
               .agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__null", _any_null(keys)))
    keyed = F.when(~F.col("__null"), F.col("__n"))
    row = per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.coalesce(F.max(keyed), F.lit(0)).alias("max_n"),
        F.coalesce(F.sum(F.when(F.col("__null"), F.col("__n"))), F.lit(0)).alias("nulls"),
        F.max_by(F.struct(*[F.col(f"`{k}`") for k in keys]), keyed).alias("worst"),
    ).first()
    worst = row["worst"].asDict() if row["worst"] is not None else None
    return SourceProfile(int(row["rows"]), int(row["max_n"]), int(row["nulls"]), worst)


def check_source_keys(source: DataFrame, keys: Sequence[str], null_keys: str = "fail",
                      key_types: Mapping[str, T.DataType] | None = None) -> SourceProfile:
    """Profile the source now and raise if two rows share a key (one target
    row may match at most one source row), or, with ``null_keys="fail"``, if
    a key is NULL. (``merge`` and the dimension steps make the same check
    inside their plan; this is for looking before.)"""
    profile = profile_source(source, keys, key_types)
    if profile.max_rows_per_key > 1:
        raise ValueError(f"source has {profile.max_rows_per_key} rows for key "
                         f"{profile.worst_key}: a merge source must have one row per key "
                         f"(dedupe it first)")
    if null_keys == "fail" and profile.null_key_rows:
        raise ValueError(f"source has {profile.null_key_rows} rows with a NULL key; pass "
                         f"null_keys='insert' to insert such rows")
    return profile


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` value(s); of
    rows that tie there, the one with the greatest hash of its other columns
    (the same in every run; maps take no part in the hash).

    An aggregation (``max_by`` over a struct), not a window, so rows of a hot
    key are reduced inside each map task before the shuffle.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c.lower() not in {k.lower() for k in keys}]
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not has_map(f.dataType)]
    ordering = F.struct(*[F.col(f"`{c}`") for c in order], F.xxhash64(*hashed))
    picked = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), ordering).alias("__row")
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(picked)
    return out.select(*[F.col(f"`{k}`") for k in keys],
                      *[F.col("__row").getField(c).alias(c) for c in rest]).select(*df.columns)


# ---------------------------------------------------------------------------
# the aligned join

def split_target(target: DataFrame, keys: Sequence[str], target_filter: Column | None,
                 bypass_filter: Column | None = None):
    """(eligible, bypass): rows that can match, and rows that pass through.

    Both predicates are written in forms the parquet scan can push down
    (``IsNotNull``/``IsNull``, ``=``/``<>``, ``AND``/``OR``), so row groups of
    the other side are skipped from footer statistics. ``bypass_filter`` is
    the exact complement of ``target_filter`` in such a form when the caller
    knows one; by default it is ``target_filter IS NULL OR NOT target_filter``.
    """
    keys_present = ~_any_null(keys)
    keys_missing = _any_null(keys)
    if target_filter is None:
        return target.filter(keys_present), target.filter(keys_missing)
    if bypass_filter is None:
        bypass_filter = target_filter.isNull() | ~target_filter
    return target.filter(keys_present & target_filter), target.filter(keys_missing | bypass_filter)


def _repeated(keys: Sequence[str]) -> Column:
    """True, or an error if the row stands for several source rows."""
    problem = F.concat(F.lit("source has "), F.col(S_ROWS).cast("string"), F.lit(" rows for key "),
                       F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(
                           c.removeprefix(S_PREFIX)) for c in keys])),
                       F.lit(": a merge source must have one row per key (dedupe it first)"))
    return F.when(F.col(S_ROWS) > 1, F.raise_error(problem).cast("boolean")).otherwise(F.lit(True))


def one_per_key(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key, with the number of its rows (``S_ROWS``)."""
    by = [F.col(f"`{c}`") for c in keys]
    rest = [c for c in keyed.columns if c not in keys]
    return keyed.groupBy(F.xxhash64(*by).alias("__dealt"), *by).agg(
        F.count(F.lit(1)).alias(S_ROWS),
        *[F.first(F.col(f"`{c}`")).alias(c) for c in rest]).drop("__dealt")


def repeated_keys(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No rows, or an error while the plan runs if two rows share a key."""
    by = [F.col(f"`{c}`") for c in keys]
    counted = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias(S_ROWS))
    return counted.filter(~_repeated(keys))


def aligned_join(eligible: DataFrame, source: DataFrame, keys: Sequence[tuple[str, str]], *,
                 strategy: str = "auto", null_keys: str = "fail", check: bool = True,
                 with_target: bool = True, unmatched_source: bool = True) -> DataFrame:
    """Every eligible target row (with its matching source row or NULLs) and
    every unmatched source row, with columns ``t__*``, ``s__*`` and the side
    markers ``__t`` / ``__s``. Source keys are cast to the target key types,
    and are checked after the cast (``check``; see the module's docstring).

    A source row with a NULL key matches nothing: with ``null_keys="insert"``
    it is an unmatched row (kept out of the joins, so many of them cannot pile
    up in one partition), else it raises while the plan runs.
    ``unmatched_source=False`` (an update-only merge) leaves the unmatched
    source rows out, ``with_target=False`` (an insert-only merge) the target
    rows.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if null_keys not in NULL_KEYS:
        raise ValueError("null_keys must be 'fail' or 'insert'")
    if strategy == "broadcast" and size_bound(
            source, *broadcast_limits(source.sparkSession)) is None:
        strategy = "auto"
    key_types = {_field(source, s).name: _field(eligible, t).dataType for t, s in keys}
    tside = eligible.select(*[F.col(f"`{c}`").alias(T_PREFIX + c) for c in eligible.columns],
                            F.lit(True).alias(T_MARK))
    sside = source.select(*[
        (F.col(f"`{c}`").cast(key_types[c]) if c in key_types else F.col(f"`{c}`")).alias(S_PREFIX + c)
        for c in source.columns], F.lit(True).alias(S_MARK))
    tk = [T_PREFIX + _field(eligible, t).name for t, _ in keys]
    sk = [S_PREFIX + _field(source, s).name for _, s in keys]
    keyed, unkeyed = sside.filter(~_any_null(sk)), sside.filter(_any_null(sk))
    if null_keys == "fail":
        unkeyed = unkeyed.filter(F.raise_error(F.lit(
            "source has a row with a NULL key; pass null_keys='insert' to insert such rows"))
            .cast("boolean"))
    every = keyed
    if check:
        keyed = one_per_key(keyed, sk)
    out_cols = [F.col(f"`{c}`") for c in [*tside.columns, *sside.columns]]
    hint = {"broadcast": "broadcast", "shuffle": "merge"}.get(strategy)

    def checked(df: DataFrame) -> DataFrame:
        return df.filter(_repeated(sk)) if check else df

    def hinted(df: DataFrame) -> DataFrame:
        return df.hint(hint) if hint else df

    t_nulls = [F.lit(None).cast(f.dataType).alias(T_PREFIX + f.name) for f in eligible.schema.fields]
    t_nulls.append(F.lit(None).cast("boolean").alias(T_MARK))

    def source_only_rows(df: DataFrame) -> DataFrame:
        return df.select(*t_nulls, *[F.col(f"`{c}`") for c in sside.columns])

    parts = []
    if with_target:
        cond = _and([F.col(f"`{a}`") == F.col(f"`{b}`") for a, b in zip(tk, sk)])
        parts.append(checked(tside.join(hinted(keyed), cond, "left")).select(*out_cols))
    if unmatched_source:
        held = tside.select(*[F.col(f"`{a}`").alias(f"h{a}") for a in tk])
        hit_cond = _and([F.col(f"`{b}`") == F.col(f"`h{a}`") for a, b in zip(tk, sk)])
        if strategy == "broadcast":
            # the keys of the source that the target has: at most one for each source row
            source_keys = keyed.select(*[F.col(f"`{b}`") for b in sk])
            held = held.join(F.broadcast(source_keys), hit_cond, "left_semi")
        parts.append(source_only_rows(checked(
            keyed.join(hinted(held.distinct()), hit_cond, "left_anti"))))
    if unmatched_source or null_keys == "fail":
        parts.append(source_only_rows(unkeyed))
    if check and not (with_target and unmatched_source):
        no_rows = repeated_keys(every, sk)
        parts.append(source_only_rows(no_rows.select(*[
            F.lit(None).cast(f.dataType).alias(f.name) for f in sside.schema.fields])))
    return reduce(DataFrame.unionByName, parts)


def matched() -> Column:
    return F.col(T_MARK).isNotNull() & F.col(S_MARK).isNotNull()


def source_only() -> Column:
    return F.col(T_MARK).isNull()


# ---------------------------------------------------------------------------
# merge (I1-I3, I14)

def merge(target: DataFrame, source: DataFrame, on, *,
          update: Mapping | str | None = None,
          insert: Mapping | str | None = None,
          update_when: Column | str | None = None,
          target_filter: Column | None = None,
          null_keys: str = "fail", check: bool = True,
          strategy: str = "auto") -> DataFrame:
    """MERGE INTO target USING source ON keys, as a new snapshot.

    - ``update``: {target column: expression} applied to matched rows (when
      ``update_when`` holds), or ``"*"`` for every target column the source
      has; columns not listed keep their value.
    - ``insert``: {target column: expression} for unmatched source rows, or
      ``"*"`` for all; target columns not listed are NULL.
    - ``target_filter``: extra match condition on the target alone (as in
      ``ON t.id = s.id AND t.flag = 'Y'``); failing rows pass through.
    - ``null_keys``: ``"fail"`` (default) or ``"insert"`` (NULL never matches,
      so such a source row is inserted).
    - ``check=False`` skips the check that source keys are unique (for a
      source that is so by construction, such as ``dedupe_latest``'s).
    Unmatched target rows are kept (no delete clause exists in this API).
    Without ``update`` no target row can change: the result is the target and
    the rows of ``insert_rows``, and the target is not joined or shuffled.
    """
    keys = key_pairs(on)
    if update is None:
        if insert is None:
            raise ValueError("a merge needs update or insert")
        return target.unionByName(insert_rows(target, source, on, insert,
                                              target_filter=target_filter, null_keys=null_keys,
                                              check=check, strategy=strategy))
    eligible, bypass = split_target(target, [t for t, _ in keys], target_filter)
    al = aligned_join(eligible, source, keys, strategy=strategy, null_keys=null_keys, check=check,
                      unmatched_source=insert is not None)
    return al.select(*_merged_columns(target, source, update, insert, update_when)) \
        .unionByName(bypass)


def _merged_columns(target: DataFrame, source: DataFrame, update, insert, update_when) -> list[Column]:
    """The target's columns over the rows of an aligned join."""

    src_names = {c.lower(): c for c in source.columns}

    def spec_map(spec) -> dict[str, Column]:
        if spec is None:
            return {}
        if spec == "*":
            out = {}
            for f in target.schema.fields:
                if f.name.lower() not in src_names:
                    raise ValueError(f"source lacks target column {f.name!r} for '*'")
                out[f.name.lower()] = src(src_names[f.name.lower()])
            return out
        return {_field(target, k).name.lower(): resolve_expr(v, target, source)
                for k, v in spec.items()}

    upd, ins = spec_map(update), spec_map(insert)
    if isinstance(update_when, str):
        update_when = resolve_expr(update_when, target, source)
    do_update = matched() & (F.coalesce(update_when, F.lit(False)) if update_when is not None
                             else F.lit(True))
    cols = []
    for f in target.schema.fields:
        keep = tgt(f.name)
        new_val = upd.get(f.name.lower())
        ins_val = ins.get(f.name.lower(), F.lit(None))
        e = F.when(source_only(), ins_val.cast(f.dataType))
        if new_val is not None:
            e = e.when(do_update, new_val.cast(f.dataType))
        cols.append(e.otherwise(keep).alias(f.name))
    return cols


def insert_rows(target: DataFrame, source: DataFrame, on, insert: Mapping | str = "*", *,
                target_filter: Column | None = None, null_keys: str = "fail", check: bool = True,
                strategy: str = "auto") -> DataFrame:
    """Only the rows that an insert-only merge adds, as target rows: what to
    append to the stored table instead of writing all of it again."""
    keys = key_pairs(on)
    eligible, _ = split_target(target, [t for t, _ in keys], target_filter)
    al = aligned_join(eligible, source, keys, strategy=strategy, null_keys=null_keys, check=check,
                      with_target=False)
    return al.select(*_merged_columns(target, source, None, insert, None))


def insert_new(target: DataFrame, source: DataFrame, on, insert: Mapping | str = "*", *,
               target_filter: Column | None = None, strategy: str = "auto",
               check: bool = True) -> DataFrame:
    """Insert-only merge: the target and the source rows whose key has no
    (eligible) target row (``insert_rows``)."""
    return merge(target, source, on, insert=insert, target_filter=target_filter,
                 strategy=strategy, check=check)


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT INTO target SELECT ...: rows matched to the target by name,
    cast to its types (columns the rows lack are NULL)."""
    by_name = {c.lower(): c for c in rows.columns}
    extra = set(by_name) - {c.lower() for c in target.columns}
    if extra:
        raise ValueError(f"columns not in target: {sorted(extra)}")
    return target.unionByName(rows.select(*[
        (F.col(f"`{by_name[f.name.lower()]}`") if f.name.lower() in by_name else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in target.schema.fields]))
