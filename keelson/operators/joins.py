"""Joins: equi-joins by name or expression, semi/anti, md5 surrogate-key joins.

Physical strategy is left to Catalyst and AQE: a side whose size (estimated,
or measured at a shuffle) is under ``spark.sql.autoBroadcastJoinThreshold``
is broadcast, everything else is a sort-merge join on the key, and AQE splits
skewed partitions at run time. Two cases are planned here because Spark
cannot fix them at run time: right and full outer joins (see ``join_on``),
and semi/anti joins, which join only the distinct right keys. Cross joins are
not offered: every join here needs an equality key.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.hashing import md5_key
from keelson.operators.merging import has_map

_HOW = {
    "inner": "inner", "left": "left", "left_outer": "left", "leftouter": "left",
    "right": "right", "right_outer": "right", "rightouter": "right",
    "full": "full", "outer": "full", "full_outer": "full", "fullouter": "full",
    "left_semi": "left_semi", "semi": "left_semi", "leftsemi": "left_semi",
    "left_anti": "left_anti", "anti": "left_anti", "leftanti": "left_anti",
}


def join_type(how: str) -> str:
    try:
        return _HOW[how.lower()]
    except KeyError:
        raise ValueError(f"unsupported join type {how!r}; cross joins are not offered") from None


def join_on(left: DataFrame, right: DataFrame,
            on: str | Sequence[str] | Mapping[str, str] | Column,
            how: str = "inner") -> DataFrame:
    """Equi-join on shared key names (one key column out, coalesced for full
    joins), on a mapping left-name -> right-name, or on an equality
    expression (both key columns kept for the last two). Names match without
    regard to case, as in Spark.

    Right and full outer joins are planned as an inner (left) join and the
    right rows that match no left row. Spark can neither
    broadcast the preserved side of an outer join nor split its skewed
    partitions: a fact table joined that way to a 25-row dimension keeps 25
    reducers busy however large it is. The inner (left) join can be broadcast
    or split, and the left side's keys (the columns that an expression names)
    are reduced to distinct ones in each map task before the anti join. The
    plan is the same at every size. An expression may hold conditions besides
    equalities; Catalyst takes the equalities as keys in both joins.
    """
    how = join_type(how)
    if isinstance(on, Column):
        if how not in ("right", "full"):
            return left.join(right, on, how)
        main = left.join(right, on, "inner" if how == "right" else "left")
        missed = right.join(_named_in(left, on), on, "left_anti")
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
        return main.union(missed.select(*nulls, "*"))
    shared = not isinstance(on, Mapping)
    named = ([(on, on)] if isinstance(on, str) else
             [(k, k) for k in on] if shared else list(on.items()))
    pairs = [(_named(left, a), _named(right, b)) for a, b in named]
    if how in ("right", "full"):
        main = _equi(left, right, pairs, shared, "inner" if how == "right" else "left")
        return main.union(_unmatched_right(left, right, pairs, shared))
    return _equi(left, right, pairs, shared, how)


def _named_in(df: DataFrame, condition: Column) -> DataFrame:
    """The distinct values of the columns of ``df`` that a condition names
    (by their names' occurrence in its text, so perhaps a few more)."""
    text = str(condition)
    named = [c for c in df.columns
             if re.search(rf"(?<!\w){re.escape(c)}(?!\w)", text, re.IGNORECASE)]
    if not named or any(has_map(df.schema[c].dataType) for c in named):
        return df
    return df.select(*[F.col(f"`{c}`") for c in named]).distinct()


def _named(df: DataFrame, name: str) -> str:
    """The column of ``df`` with that name, in its own spelling."""
    return next((c for c in df.columns if c.lower() == name.lower()), name)


def _equi(left: DataFrame, right: DataFrame, pairs, shared: bool, how: str) -> DataFrame:
    if shared:
        return left.join(right, [k for k, _ in pairs], how)
    cond = _and_all([left[f"`{a}`"] == right[f"`{b}`"] for a, b in pairs])
    return left.join(right, cond, how)


def _unmatched_right(left: DataFrame, right: DataFrame, pairs, shared: bool) -> DataFrame:
    """Right rows whose key no left row has, in the columns of the join."""
    held = left.select(*[F.col(f"`{a}`").alias(f"__h{i}")
                         for i, (a, _) in enumerate(pairs)]).distinct()
    missed = right.join(held, _and_all(
        [right[f"`{b}`"] == held[f"__h{i}"] for i, (_, b) in enumerate(pairs)]), "left_anti")
    by_left = {a: b for a, b in pairs} if shared else {}
    fields = left.schema.fields
    if shared:  # the keys first, as a join on names puts them
        fields = [f for a in by_left for f in fields if f.name == a] + \
            [f for f in fields if f.name not in by_left]
    cols = [F.col(f"`{by_left[f.name]}`").cast(f.dataType).alias(f.name) if f.name in by_left
            else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    gone = set(by_left.values())
    return missed.select(*cols, *[F.col(f"`{c}`") for c in right.columns if c not in gone])


def _and_all(preds) -> Column:
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def semi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str] | Column,
              anti: bool = False) -> DataFrame:
    """Rows of ``left`` with (or, ``anti``, without) a match in ``right``.

    No fan-out: a left row appears at most once. In the anti join a left row
    with a NULL key has no match and is kept.

    Only the distinct keys of ``right`` (the columns that are named, or that
    an expression names) are joined: the
    distinct runs as a partial aggregate in each map task, so a key that
    holds a third of ``right`` reaches the join as one row instead of a hot
    partition, and a small key set can be broadcast.
    """
    how = "left_anti" if anti else "left_semi"
    if isinstance(on, Column):
        return left.join(_named_in(right, on), on, how)
    pairs = ([(on, on)] if isinstance(on, str) else
             list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on])
    keys = right.select(*[F.col(f"`{r}`").alias(f"__k{i}") for i, (_, r) in enumerate(pairs)]) \
        .distinct()
    cond = None
    for i, (lk, _) in enumerate(pairs):
        c = left[lk] == keys[f"__k{i}"]
        cond = c if cond is None else cond & c
    return left.join(keys, cond, how)


def hash_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str] | Mapping[str, str],
                  how: str = "inner", key_name: str = "hash_key") -> DataFrame:
    """Join on an md5 surrogate key made on both sides.

    ``keys`` is a list of names present on both sides, or a mapping
    left-name -> right-name. Keys are cast to the type both sides widen to
    before they are hashed, and every value has one text there, so rows match
    as they would on the keys themselves (int and double, decimals of two
    scales, 0.0 and -0.0, moments in any time zone). The surrogate is one ``key_name`` column; it is
    NULL if any of its keys is, and so matches nothing, as the keys would.
    Right columns whose names repeat a left column are dropped, so the result
    has no ambiguous names; a key column that both sides have by one name is
    filled from the right where a row comes from there alone.
    """
    how = join_type(how)
    pairs = list(keys.items()) if isinstance(keys, Mapping) else [(k, k) for k in keys]
    pairs = [(_named(left, a), _named(right, b)) for a, b in pairs]

    types = [f.dataType for f in _keys_only(left, [a for a, _ in pairs]).union(
        _keys_only(right, [b for _, b in pairs])).schema.fields]

    def surrogate(names: Sequence[str]) -> Column:
        present = _and_all([F.col(f"`{n}`").isNotNull() for n in names])
        return F.when(present, md5_key(*[F.col(f"`{n}`") for n in names], types=types))

    lk = left.withColumn(key_name, surrogate([a for a, _ in pairs]))
    rk = right.withColumn(key_name, surrogate([b for _, b in pairs]))
    if how in ("left_semi", "left_anti"):
        return lk.join(rk.select(key_name).distinct(), key_name, how)
    left_names = {c.lower() for c in lk.columns}
    same = {a: f"__right_{i}" for i, (a, b) in enumerate(pairs) if a.lower() == b.lower()}
    keep = [F.col(f"`{c}`") for c in rk.columns if c == key_name or c.lower() not in left_names]
    keep += [F.col(f"`{b}`").alias(same[a]) for a, b in pairs if a in same]
    joined = join_on(lk, rk.select(*keep), key_name, how)
    filled = [F.coalesce(F.col(f"`{c}`"), F.col(same[c])).alias(c) if c in same else F.col(f"`{c}`")
              for c in joined.columns if c not in same.values()]
    return joined.select(*filled)


def _keys_only(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`").alias(f"k{i}") for i, n in enumerate(names)])


def join_aggregate(left: DataFrame, right: DataFrame, on, how: str,
                   group_by: Sequence[str | Column], aggs: Sequence[Column]) -> DataFrame:
    """Join, then group and aggregate (partial aggregation runs before the
    final shuffle, so a hot group is combined map-side)."""
    return join_on(left, right, on, how).groupBy(*group_by).agg(*aggs)
