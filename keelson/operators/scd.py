"""Slowly changing dimensions (types 1, 2 and 3) over immutable snapshots.

Type 2 in one join (``scd2``): only current rows of the target take part;
history rows bypass the join. The aligned join (see ``merging``) gives each
current row with its source row, and each unmatched source row; a changed
key emits two rows (the closed old version and the opened new one) from the
same joined row through ``inline``, so the two MERGE statements of the
classic recipe become one plan with one join. Replaying a batch under
``detect="hash"`` or ``"columns"`` changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.dates import as_of_time
from keelson.functions.hashing import row_hash
from keelson.operators.merging import (T_MARK, _field, aligned_join, key_pairs, matched, merge,
                                       split_target, src, tgt)

DETECT = ("hash", "columns", "always")
_SRC_HASH = "__src_hash"
_TGT_HASH = "__tgt_hash"
_NEW_HASH = "__new_hash"


# ---------------------------------------------------------------------------
# type 2 helpers (I5, I6, I15)

def scd2_init(df: DataFrame, as_of: str | dt.date | Column | None, *,
              flag_col: str = "cur_rec_ind", start_col: str = "start_ts", end_col: str = "end_ts",
              current_flag: str = "Y", time_type: str | T.DataType = "date",
              hash_col: str | None = None, hash_cols: Sequence[str] | None = None,
              hash_compat: bool = False) -> DataFrame:
    """A flat table as a type-2 table: every row current from ``as_of``,
    open end (NULL), optionally with a fingerprint column."""
    start = as_of_time(as_of).cast(time_type)
    out = df.select("*", F.lit(current_flag).alias(flag_col), start.alias(start_col),
                    F.lit(None).cast(time_type).alias(end_col))
    if hash_col:
        cols = list(hash_cols) if hash_cols else list(df.columns)
        out = out.withColumn(hash_col, row_hash(cols, df.schema, compat=hash_compat))
    return out


def update_where(df: DataFrame, cond: Column | str, assignments: Mapping[str, object]) -> DataFrame:
    """UPDATE df SET col = value WHERE cond, as a projection (rows where the
    condition is NULL are left alone)."""
    cond = F.expr(cond) if isinstance(cond, str) else cond
    cond = F.coalesce(cond, F.lit(False))
    lower = {k.lower(): v for k, v in assignments.items()}
    cols = []
    for f in df.schema.fields:
        if f.name.lower() in lower:
            v = lower[f.name.lower()]
            v = v if isinstance(v, Column) else F.lit(v)
            cols.append(F.when(cond, v.cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def current(df: DataFrame, flag_col: str = "cur_rec_ind", current_flag: str = "Y") -> DataFrame:
    return df.filter(F.col(flag_col) == F.lit(current_flag))


def history(df: DataFrame, flag_col: str = "cur_rec_ind", current_flag: str = "Y") -> DataFrame:
    """Rows that are not current (closed versions; a NULL flag counts as not current)."""
    flag = F.col(flag_col)
    return df.filter(flag.isNull() | (flag != F.lit(current_flag)))  # pushdown form


# ---------------------------------------------------------------------------
# type 2 (I7-I11)

def scd2(target: DataFrame, source: DataFrame, keys, as_of: str | dt.date | Column | None, *,
         detect: str = "hash", tracked: Sequence[str] | None = None,
         flag_col: str = "cur_rec_ind", start_col: str = "start_ts", end_col: str = "end_ts",
         current_flag: str = "Y", closed_flag: str = "N",
         hash_col: str | None = None, hash_compat: bool = False,
         source_has_validity: bool = False, null_keys: str = "fail",
         check: bool = True, strategy: str = "auto") -> DataFrame:
    """Apply a source batch to a type-2 table as of ``as_of``.

    For each current target row whose key is in the source:
    - changed (``detect``): the row is closed (flag ``closed_flag``, end
      ``as_of``) and the source row is opened (flag ``current_flag``, start
      ``as_of``, open end);
    - unchanged: kept as is.
    Source rows without a current row are opened; current rows absent from
    the source and all history rows are kept.

    ``detect``: ``"hash"`` compares fingerprints (the target's stored
    ``hash_col`` if it has one, else computed) NULL-safely; ``"columns"``
    compares the tracked columns NULL-safely; ``"always"`` treats every
    match as a change (the closing-and-reopening behaviour of a plain MERGE).
    ``tracked`` names the columns that count as a change (default: all that
    both sides have); a stored fingerprint covers them all, so with
    ``tracked`` the named columns are hashed afresh on both sides.
    ``source_has_validity``: the source carries its own flag/start/end
    columns and opened rows take them from it.

    ``as_of`` may be a date or a moment (``functions.dates.as_of_time``); it
    is cast to the type of the start and end columns. A row that would be
    closed before it started (a late batch) raises while the plan runs.
    """
    if detect not in DETECT:
        raise ValueError(f"detect must be one of {DETECT}")
    pairs = key_pairs(keys)
    tkeys = [_field(target, t).name for t, _ in pairs]
    skeys = [_field(source, s).name for _, s in pairs]
    validity = {flag_col.lower(), start_col.lower(), end_col.lower()}
    special = validity | ({hash_col.lower()} if hash_col else set())
    key_low = {k.lower() for k in tkeys} | {k.lower() for k in skeys}
    target_low = {c.lower() for c in target.columns}
    compares_stored = tracked is None
    shared = [c for c in source.columns if c.lower() not in key_low | special and c.lower() in target_low]
    tracked = [_field(source, c).name for c in (shared if tracked is None else tracked)]

    has_t_hash = bool(hash_col) and hash_col.lower() in target_low
    has_s_hash = bool(hash_col) and hash_col.lower() in {c.lower() for c in source.columns}
    compares_stored = compares_stored and has_t_hash
    # hash the batch as the target's types (text keys, say, as numbers)
    as_target = {s: _field(target, t).dataType for t, s in zip(tkeys, skeys)}
    as_target.update({c: _field(target, c).dataType for c in [*shared, *tracked]})
    src_df = source
    if has_t_hash:  # what opened rows store
        if has_s_hash:
            src_df = src_df.withColumn(_SRC_HASH, F.col(f"`{_field(source, hash_col).name}`"))
        else:
            # a stored fingerprint covers the keys and the shared columns in
            # the target's column order (the md5(id, name, age) form), so the
            # batch is hashed in that order whatever its own
            by_target = {t.lower(): s for t, s in zip(tkeys, skeys)}
            by_target.update({c.lower(): c for c in shared})
            hcols = [by_target[c.lower()] for c in target.columns if c.lower() in by_target]
            src_df = src_df.withColumn(_SRC_HASH, row_hash(hcols, source.schema, compat=hash_compat,
                                                           cast_to=as_target))
    if detect == "hash" and not compares_stored:
        src_df = src_df.withColumn(_NEW_HASH, row_hash(tracked, source.schema, compat=hash_compat,
                                                       cast_to=as_target))

    flag = F.col(f"`{_field(target, flag_col).name}`")
    eligible, bypass = split_target(target, tkeys, flag == F.lit(current_flag),
                                    flag.isNull() | (flag != F.lit(current_flag)))
    if detect == "hash" and not compares_stored:
        eligible = eligible.withColumn(
            _TGT_HASH, row_hash([_field(target, c).name for c in tracked], target.schema,
                                compat=hash_compat))
    al = aligned_join(eligible, src_df, list(zip(tkeys, skeys)), strategy=strategy,
                      null_keys=null_keys, check=check)

    if detect == "always":
        changed = matched()
    elif detect == "hash":
        old, new = ((tgt(_field(target, hash_col).name), src(_SRC_HASH)) if compares_stored
                    else (tgt(_TGT_HASH), src(_NEW_HASH)))
        changed = matched() & ~old.eqNullSafe(new)
    else:
        changed = matched() & ~reduce(lambda a, b: a & b, [
            tgt(_field(target, c).name).eqNullSafe(src(c).cast(_field(target, c).dataType))
            for c in tracked])

    start_type = _field(target, start_col).dataType
    end_type = _field(target, end_col).dataType
    as_of_start = as_of_time(as_of).cast(start_type)
    as_of_end = as_of_time(as_of).cast(end_type)
    started = tgt(_field(target, start_col).name)
    late = F.concat(F.lit("as_of "), as_of_end.cast("string"),
                    F.lit(" is before the start of a row it would close: "), started.cast("string"))
    as_of_end = F.when(started > as_of_start, F.raise_error(late).cast(end_type)).otherwise(as_of_end)
    s_low = {c.lower(): c for c in source.columns}
    s_map = dict(zip([k.lower() for k in tkeys], skeys))

    kept, closed, opened = [], [], []
    for f in target.schema.fields:
        name, low = f.name, f.name.lower()
        keep = tgt(name)
        kept.append(keep.alias(name))
        if low == flag_col.lower():
            closed.append(F.lit(closed_flag).cast(f.dataType).alias(name))
        elif low == end_col.lower():
            closed.append(as_of_end.alias(name))
        else:
            closed.append(keep.alias(name))
        # the opened version
        if low in validity:
            if source_has_validity:
                val = src(s_low[low])
            elif low == flag_col.lower():
                val = F.lit(current_flag)
            elif low == start_col.lower():
                val = as_of_start
            else:
                val = F.lit(None)
        elif hash_col and low == hash_col.lower():
            val = src(_SRC_HASH)
        elif low in s_map:
            val = src(s_map[low])
        elif low in s_low:
            val = src(s_low[low])
        else:
            val = F.lit(None)
        opened.append(val.cast(f.dataType).alias(name))

    versions = (F.when(changed, F.array(F.struct(*closed), F.struct(*opened)))
                .when(F.col(T_MARK).isNotNull(), F.array(F.struct(*kept)))
                .otherwise(F.array(F.struct(*opened))))
    return al.select(F.inline(versions)).unionByName(bypass)


# ---------------------------------------------------------------------------
# type 1 and type 3 (I4, I13)

def scd1(target: DataFrame, source: DataFrame, keys, *,
         update_cols: Sequence[str] | None = None, insert_cols: Sequence[str] | str = "*",
         changed_only: bool = False, check: bool = True, strategy: str = "auto") -> DataFrame:
    """Latest value only: matched keys take the source's ``update_cols``
    (default: every non-key target column the source has), new keys are
    inserted with ``insert_cols`` (others NULL). ``changed_only`` limits the
    update to rows whose update columns differ (NULL-safe), which leaves
    unchanged rows untouched."""
    pairs = key_pairs(keys)
    tk = {t.lower() for t, _ in pairs}
    s_low = {c.lower(): c for c in source.columns}
    if update_cols is None:
        update_cols = [c for c in target.columns if c.lower() not in tk and c.lower() in s_low]
    update = {c: src(s_low[c.lower()]) for c in update_cols}
    insert = insert_cols if insert_cols == "*" else {c: src(s_low[c.lower()]) for c in insert_cols}
    when = None
    if changed_only and update_cols:
        when = ~reduce(lambda a, b: a & b, [
            tgt(_field(target, c).name).eqNullSafe(src(s_low[c.lower()]).cast(_field(target, c).dataType))
            for c in update_cols])
    return merge(target, source, keys, update=update, insert=insert, update_when=when,
                 check=check, strategy=strategy)


def scd3(target: DataFrame, source: DataFrame, keys, *, value_col: str,
         prev_col: str = "prev_value", curr_col: str = "curr_value",
         attributes: Sequence[str] | None = None, update_attributes: bool = False,
         hash_col: str | None = None, hash_compat: bool = False, init_prev=None,
         detect: str = "columns", check: bool = True, strategy: str = "auto") -> DataFrame:
    """Previous + current value.

    A matched key whose source ``value_col`` differs from ``curr_col``
    (``detect="columns"``, NULL-safe) or whose fingerprint differs
    (``detect="hash"``) gets ``prev = curr, curr = source value``; a new key
    is inserted with ``prev = init_prev`` (NULL) and ``curr`` = its value.
    A stored ``hash_col`` is refreshed on update, so replaying the batch
    changes nothing. ``attributes`` (default: the other shared columns) are
    copied on insert, and on update too with ``update_attributes``.
    """
    pairs = key_pairs(keys)
    tkeys = [_field(target, t).name for t, _ in pairs]
    skeys = [_field(source, s).name for _, s in pairs]
    s_low = {c.lower(): c for c in source.columns}
    special = {prev_col.lower(), curr_col.lower(), value_col.lower()}
    if hash_col:
        special.add(hash_col.lower())
    if attributes is None:
        attributes = [c for c in target.columns if c.lower() in s_low
                      and c.lower() not in special and c.lower() not in {k.lower() for k in tkeys}]
    curr_type = _field(target, curr_col).dataType
    new_val = src(s_low[value_col.lower()]).cast(curr_type)

    src_df = source
    if hash_col:
        # the target's column order, with the current value where curr_col is
        by_target = {t.lower(): s for t, s in zip(tkeys, skeys)}
        by_target.update({a.lower(): s_low[a.lower()] for a in attributes})
        by_target[curr_col.lower()] = s_low[value_col.lower()]
        hcols = [by_target[c.lower()] for c in target.columns if c.lower() in by_target]
        as_target = {s: _field(target, t).dataType for t, s in zip(tkeys, skeys)}
        as_target.update({s_low[a.lower()]: _field(target, a).dataType for a in attributes})
        as_target[s_low[value_col.lower()]] = curr_type
        src_df = source.withColumn("__scd3_hash", row_hash(hcols, source.schema, compat=hash_compat,
                                                           cast_to=as_target))
    if detect == "hash":
        if not hash_col or hash_col.lower() not in {c.lower() for c in target.columns}:
            raise ValueError("detect='hash' needs a stored hash_col on the target")
        when = ~tgt(_field(target, hash_col).name).eqNullSafe(src("__scd3_hash"))
    elif detect == "columns":
        when = ~tgt(_field(target, curr_col).name).eqNullSafe(new_val)
        if update_attributes:
            for a in attributes:
                when = when | ~tgt(_field(target, a).name).eqNullSafe(
                    src(s_low[a.lower()]).cast(_field(target, a).dataType))
    else:
        raise ValueError("detect must be 'columns' or 'hash'")

    update = {prev_col: tgt(_field(target, curr_col).name), curr_col: new_val}
    insert = {k: src(s) for k, s in zip(tkeys, skeys)}
    insert.update({a: src(s_low[a.lower()]) for a in attributes})
    insert[prev_col] = F.lit(init_prev)
    insert[curr_col] = new_val
    if update_attributes:
        update.update({a: src(s_low[a.lower()]) for a in attributes})
    if hash_col:
        update[hash_col] = src("__scd3_hash")
        insert[hash_col] = src("__scd3_hash")
    return merge(target, src_df.drop(*[c for c in src_df.columns if c.lower() == (hash_col or "").lower()]),
                 keys, update=update, insert=insert, update_when=when, check=check,
                 strategy=strategy)


__all__ = ["current", "history", "scd1", "scd2", "scd2_init", "scd3", "update_where"]
