"""Checked queries: keyed merge and slowly changing dimensions (I).

Target: the customer master (or its type-2 dimension); source: the next
extract ``inputs.customer_refresh``. The oracle SQL spells each MERGE out
as a left join plus the unmatched source rows; ``_scd2_sql`` writes the
type-2 step once so that two steps can be nested.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import merging as mg
from keelson.operators import scd
from keelson.plans.catalog import register
from keelson.plans.inputs import (AS_OF, CUSTOMER_COLS, INITIAL_LOAD, SECOND_AS_OF,
                                  customer_refresh, order_status_updates, table)
from keelson.session import scratch_path, stage_parquet
from keelson.sources.partitioned import merge_partitions
from keelson.sources.tables import publish_dimension, read_dimension, sql_over

SOURCE_EFFECTIVE = "2025-07-26"
DIM_OPTS = dict(flag_col="cur_rec_ind", start_col="start_date", end_col="end_date")

# ---------------------------------------------------------------------------
# SQL building blocks

_COLS = ", ".join(CUSTOMER_COLS)
_TEXT = {"c_custkey": "CAST(c_custkey AS VARCHAR)", "c_name": "c_name",
         "c_nationkey": "CAST(c_nationkey AS VARCHAR)",
         "c_acctbal": "CAST(c_acctbal AS VARCHAR)",
         "c_mktsegment": "c_mktsegment"}


def _hash_sql(exprs) -> str:
    parts = [f"COALESCE(CAST(length({e}) AS VARCHAR) || ':' || {e}, '~')" for e in exprs]
    return "md5(concat_ws('|', " + ", ".join(parts) + "))"


_CUST_HASH = _hash_sql([_TEXT[c] for c in CUSTOMER_COLS])


def _refresh_sql(raise_by: int = 100, onboard: bool = True) -> str:
    base = f"""SELECT c_custkey, c_name, c_nationkey,
      CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) + {raise_by} AS DOUBLE)
           ELSE c_acctbal END AS c_acctbal,
      CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'AUTOMOBILE' ELSE c_mktsegment END
        AS c_mktsegment
    FROM customer"""
    if not onboard:
        return base
    return base + """ UNION ALL
    SELECT s_suppkey + (SELECT max(c_custkey) + 1 FROM customer), s_name, s_nationkey, s_acctbal,
           'SUPPLIER' FROM supplier"""


def _moment(as_of: str) -> tuple[str, str]:
    """(literal, type) of a date or a moment."""
    kind = "TIMESTAMP" if len(as_of) > 10 else "DATE"
    return f"{kind} '{as_of}'", kind


def _dim_sql(start: str = INITIAL_LOAD, source: str = "customer") -> str:
    at, kind = _moment(start)
    return (f"SELECT {_COLS}, 'Y' AS cur_rec_ind, {at} AS start_date, "
            f"CAST(NULL AS {kind}) AS end_date, {_CUST_HASH} AS hash_key FROM ({source})")


def _scd2_sql(target: str, source: str, as_of: str, detect: str = "hash",
              source_validity: bool = False) -> str:
    """One type-2 step. ``target``: SELECT with the dimension columns;
    ``source``: SELECT with the customer columns (and validity columns when
    ``source_validity``); the source hash is computed here."""
    tracked = [c for c in CUSTOMER_COLS if c != "c_custkey"]
    at, kind = _moment(as_of)
    if detect == "always":
        chg_j, chg_s = "s_key IS NOT NULL", "TRUE"
    elif detect == "hash":
        chg_j, chg_s = ("s_key IS NOT NULL AND s_hash IS DISTINCT FROM hash_key",
                        "cur.hash_key IS DISTINCT FROM ss.hash_key")
    else:
        chg_j = "s_key IS NOT NULL AND (" + " OR ".join(
            f"{c} IS DISTINCT FROM s_{c}" for c in tracked) + ")"
        chg_s = "(" + " OR ".join(f"cur.{c} IS DISTINCT FROM ss.{c}" for c in tracked) + ")"
    s_cols = ", ".join(f"ss.{c} AS s_{c}" for c in tracked)
    if source_validity:
        opened = "ss.cur_rec_ind, ss.start_date, ss.end_date"
    else:
        opened = f"'Y', {at}, CAST(NULL AS {kind})"
    return f"""SELECT * FROM (
  WITH tt AS ({target}),
       cur AS (SELECT * FROM tt WHERE cur_rec_ind = 'Y'),
       hist AS (SELECT * FROM tt WHERE cur_rec_ind IS DISTINCT FROM 'Y'),
       ss AS (SELECT *, {_CUST_HASH} AS hash_key FROM ({source})),
       j AS (SELECT cur.*, ss.c_custkey AS s_key, ss.hash_key AS s_hash, {s_cols}
             FROM cur LEFT JOIN ss ON cur.c_custkey = ss.c_custkey)
  SELECT {_COLS}, CASE WHEN {chg_j} THEN 'N' ELSE cur_rec_ind END AS cur_rec_ind, start_date,
         CASE WHEN {chg_j} THEN {at} ELSE end_date END AS end_date, hash_key FROM j
  UNION ALL SELECT * FROM hist
  UNION ALL SELECT {', '.join('ss.' + c for c in CUSTOMER_COLS)}, {opened}, ss.hash_key
            FROM ss LEFT JOIN cur ON ss.c_custkey = cur.c_custkey
            WHERE cur.c_custkey IS NULL OR {chg_s})"""


# ---------------------------------------------------------------------------
# Spark side

def customer_dimension(spark, sf):
    """The customer master as a type-2 dimension loaded on INITIAL_LOAD."""
    return scd.scd2_init(table(spark, sf, "customer").select(*CUSTOMER_COLS), INITIAL_LOAD,
                         hash_col="hash_key", **DIM_OPTS)


def _scd2(target, source, as_of, **kw):
    return scd.scd2(target, source, "c_custkey", as_of, hash_col="hash_key", **DIM_OPTS, **kw)


@register("i5_scd2_init", _dim_sql())
def i5_scd2_init(spark, sf):
    return customer_dimension(spark, sf)


@register("i6_update_where", f"""
SELECT {_COLS}, CASE WHEN c_mktsegment = 'BUILDING' THEN 'N' ELSE cur_rec_ind END AS cur_rec_ind,
       start_date, CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '{AS_OF}' ELSE end_date END AS end_date,
       hash_key
FROM ({_dim_sql()})""")
def i6_update_where(spark, sf):
    return scd.update_where(customer_dimension(spark, sf), F.col("c_mktsegment") == "BUILDING",
                            {"cur_rec_ind": "N", "end_date": F.lit(AS_OF).cast("date")})


@register("i7_scd2_always", _scd2_sql(_dim_sql(), _refresh_sql(), AS_OF, "always"))
def i7_scd2_always(spark, sf):
    return _scd2(customer_dimension(spark, sf), customer_refresh(spark, sf), AS_OF, detect="always")


@register("i9_scd2_hash", _scd2_sql(_dim_sql(), _refresh_sql(), AS_OF, "hash"))
def i9_scd2_hash(spark, sf):
    return _scd2(customer_dimension(spark, sf), customer_refresh(spark, sf), AS_OF, detect="hash")


@register("i9_scd2_hash_shuffle", _scd2_sql(_dim_sql(), _refresh_sql(), AS_OF, "hash"))
def i9_scd2_hash_shuffle(spark, sf):
    return _scd2(customer_dimension(spark, sf), customer_refresh(spark, sf), AS_OF, detect="hash",
                 strategy="shuffle")


@register("i9_scd2_hash_broadcast", _scd2_sql(_dim_sql(), _refresh_sql(), AS_OF, "hash"))
def i9_scd2_hash_broadcast(spark, sf):
    return _scd2(customer_dimension(spark, sf), customer_refresh(spark, sf), AS_OF, detect="hash",
                 strategy="broadcast")


@register("i9_scd2_columns", _scd2_sql(_dim_sql(), _refresh_sql(), AS_OF, "columns"))
def i9_scd2_columns(spark, sf):
    return _scd2(customer_dimension(spark, sf), customer_refresh(spark, sf), AS_OF,
                 detect="columns")


_TWO_STEPS = _scd2_sql(_scd2_sql(_dim_sql(), _refresh_sql(), AS_OF, "hash"),
                       _refresh_sql(200, onboard=False), SECOND_AS_OF, "hash")


def _two_steps(spark, sf):
    # the second step reads its target in three branches (current rows,
    # their keys, history): write the first step once, laid out by currency,
    # instead of recomputing it per branch
    first = stage_parquet(_scd2(customer_dimension(spark, sf), customer_refresh(spark, sf), AS_OF),
                          "first-step")
    return _scd2(first, customer_refresh(spark, sf, raise_by=200), SECOND_AS_OF)


@register("i8_scd2_history_present", _TWO_STEPS)
def i8_scd2_history_present(spark, sf):
    return _two_steps(spark, sf)


@register("i15_current_view", f"SELECT * FROM ({_TWO_STEPS}) WHERE cur_rec_ind = 'Y'")
def i15_current_view(spark, sf):
    return scd.current(_two_steps(spark, sf))


@register("i15_history_view",
          f"SELECT * FROM ({_TWO_STEPS}) WHERE cur_rec_ind IS DISTINCT FROM 'Y'")
def i15_history_view(spark, sf):
    return scd.history(_two_steps(spark, sf))


_VALIDITY_SOURCE = (f"SELECT {_COLS}, 'Y' AS cur_rec_ind, DATE '{SOURCE_EFFECTIVE}' AS start_date, "
                    f"CAST(NULL AS DATE) AS end_date FROM ({_refresh_sql()})")


@register("i10_scd2_source_validity",
          _scd2_sql(_dim_sql(), _VALIDITY_SOURCE, AS_OF, "hash", source_validity=True))
def i10_scd2_source_validity(spark, sf):
    source = scd.scd2_init(customer_refresh(spark, sf), SOURCE_EFFECTIVE, hash_col="hash_key",
                           **DIM_OPTS)
    return _scd2(customer_dimension(spark, sf), source, AS_OF, source_has_validity=True)


# ---------------------------------------------------------------------------
# type 1 and plain merges

_SCD1_SQL = f"""
WITH r AS ({_refresh_sql()})
SELECT * FROM r
UNION ALL SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.c_custkey = c.c_custkey)"""


@register("i4_scd1", _SCD1_SQL)
def i4_scd1(spark, sf):
    return scd.scd1(table(spark, sf, "customer"), customer_refresh(spark, sf), "c_custkey")


@register("i3_merge_update_all_insert_all", _SCD1_SQL)
def i3_merge_update_all_insert_all(spark, sf):
    return mg.merge(table(spark, sf, "customer"), customer_refresh(spark, sf), "c_custkey",
                    update="*", insert="*")


@register("i1_upsert_listed_columns", f"""
WITH r AS ({_refresh_sql()})
SELECT c.c_custkey, c.c_name, c.c_nationkey,
       CASE WHEN r.c_custkey IS NOT NULL THEN r.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
       c.c_mktsegment
FROM customer c LEFT JOIN r ON c.c_custkey = r.c_custkey
UNION ALL
SELECT r.c_custkey, r.c_name, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR)
FROM r WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = r.c_custkey)""")
def i1_upsert_listed_columns(spark, sf):
    return mg.merge(table(spark, sf, "customer"), customer_refresh(spark, sf), "c_custkey",
                    update={"c_acctbal": "source.c_acctbal"},
                    insert={"c_custkey": "source.c_custkey", "c_name": "source.c_name"})


@register("i2_upsert_insert_all", f"""
WITH r AS ({_refresh_sql()})
SELECT c.c_custkey,
       CASE WHEN r.c_custkey IS NOT NULL THEN r.c_name ELSE c.c_name END AS c_name,
       c.c_nationkey,
       CASE WHEN r.c_custkey IS NOT NULL THEN r.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
       c.c_mktsegment
FROM customer c LEFT JOIN r ON c.c_custkey = r.c_custkey
UNION ALL
SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = r.c_custkey)""")
def i2_upsert_insert_all(spark, sf):
    return mg.merge(table(spark, sf, "customer"), customer_refresh(spark, sf), "c_custkey",
                    update={"c_name": mg.src("c_name"), "c_acctbal": mg.src("c_acctbal")},
                    insert="*")


@register("i14_insert_only_merge", f"""
WITH r AS ({_refresh_sql()})
SELECT * FROM customer
UNION ALL SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = r.c_custkey)""")
def i14_insert_only_merge(spark, sf):
    return mg.insert_new(table(spark, sf, "customer"), customer_refresh(spark, sf), "c_custkey")


@register("i12_insert_select", f"""
SELECT * FROM customer UNION ALL
SELECT s_suppkey + (SELECT max(c_custkey) + 1 FROM customer), s_name, s_nationkey, s_acctbal,
       CAST(NULL AS VARCHAR) FROM supplier""")
def i12_insert_select(spark, sf):
    c = table(spark, sf, "customer")
    next_key = c.select(F.max("c_custkey") + 1).scalar()
    rows = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + next_key).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"))
    return mg.append_rows(c, rows)


# ---------------------------------------------------------------------------
# type 3

_S3_HASH = _hash_sql(["CAST(c_custkey AS VARCHAR)", "c_name", "c_mktsegment"])
_SCD3_SQL = f"""
WITH t AS (SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS prev_segment,
                  c_mktsegment AS curr_segment, {_S3_HASH} AS hash_key FROM customer),
     r AS (SELECT c_custkey, c_name, c_mktsegment, {_S3_HASH} AS hash_key FROM ({_refresh_sql()})),
     j AS (SELECT t.*, r.c_custkey AS r_key, r.c_mktsegment AS r_segment, r.hash_key AS r_hash
           FROM t LEFT JOIN r ON t.c_custkey = r.c_custkey)
SELECT c_custkey, c_name,
       CASE WHEN r_key IS NOT NULL AND r_hash IS DISTINCT FROM hash_key THEN curr_segment
            ELSE prev_segment END AS prev_segment,
       CASE WHEN r_key IS NOT NULL AND r_hash IS DISTINCT FROM hash_key THEN r_segment
            ELSE curr_segment END AS curr_segment,
       CASE WHEN r_key IS NOT NULL AND r_hash IS DISTINCT FROM hash_key THEN r_hash
            ELSE hash_key END AS hash_key
FROM j
UNION ALL
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR), c_mktsegment, hash_key FROM r
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = r.c_custkey)"""


def _scd3_target(spark, sf):
    from keelson.functions.hashing import row_hash
    c = table(spark, sf, "customer")
    t = c.select("c_custkey", "c_name", F.lit(None).cast("string").alias("prev_segment"),
                 F.col("c_mktsegment").alias("curr_segment"))
    return t.withColumn("hash_key", row_hash(["c_custkey", "c_name", "curr_segment"], t.schema))


def _scd3(target, source):
    return scd.scd3(target, source.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey",
                    value_col="c_mktsegment", prev_col="prev_segment", curr_col="curr_segment",
                    hash_col="hash_key", detect="hash")


@register("i13_scd3", _SCD3_SQL)
def i13_scd3(spark, sf):
    return _scd3(_scd3_target(spark, sf), customer_refresh(spark, sf))


@register("i13_scd3_replay_is_noop", _SCD3_SQL)
def i13_scd3_replay_is_noop(spark, sf):
    once = stage_parquet(_scd3(_scd3_target(spark, sf), customer_refresh(spark, sf)), "scd3")
    return _scd3(once, customer_refresh(spark, sf))


# ---------------------------------------------------------------------------
# source-key guard (I16)

@register("i16_dedupe_latest", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def i16_dedupe_latest(spark, sf):
    return mg.dedupe_latest(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


@register("i8_scd2_dimension_store", _TWO_STEPS)
def i8_scd2_dimension_store(spark, sf):
    # the same two steps through the append-only-history store: each step
    # reads only the current folder of the newest run and writes its current
    # rows plus the rows it closed; history is never reread or rewritten
    base = scratch_path(spark, "customer-dimension")
    publish_dimension(customer_dimension(spark, sf), base, 1)
    for version, (batch, as_of) in enumerate(
            [(customer_refresh(spark, sf), AS_OF),
             (customer_refresh(spark, sf, raise_by=200), SECOND_AS_OF)], start=2):
        current = read_dimension(spark, base, current_only=True)
        publish_dimension(_scd2(current, batch, as_of), base, version)
    return read_dimension(spark, base)


@register("i11_scd2_from_sql_views", _scd2_sql(_dim_sql(), _refresh_sql(), AS_OF, "hash"))
def i11_scd2_from_sql_views(spark, sf):
    # the batch arrives through SQL over temp views with its key as text
    # (as an untyped extract would have it); the merge casts source keys to
    # the target's key type
    views = {"dim_view": customer_dimension(spark, sf), "batch_view": customer_refresh(spark, sf)}
    dim = sql_over(spark, views, "SELECT * FROM dim_view")
    batch = sql_over(spark, views, "SELECT CAST(c_custkey AS STRING) AS c_custkey, c_name, "
                                   "c_nationkey, c_acctbal, c_mktsegment FROM batch_view")
    return _scd2(dim, batch, AS_OF)


LOADS = ("2025-07-28 06:00:00", "2025-07-29 08:15:00", "2025-07-29 18:30:00.250")


@register("i7_scd2_two_loads_one_day", _scd2_sql(
    _scd2_sql(_dim_sql(LOADS[0]), _refresh_sql(), LOADS[1], "hash"),
    _refresh_sql(200, onboard=False), LOADS[2], "hash"))
def i7_scd2_two_loads_one_day(spark, sf):
    # validity in moments: two loads of one day are told apart
    dim = scd.scd2_init(table(spark, sf, "customer").select(*CUSTOMER_COLS), LOADS[0],
                        hash_col="hash_key", time_type="timestamp_ntz", **DIM_OPTS)
    first = stage_parquet(_scd2(dim, customer_refresh(spark, sf), LOADS[1]), "first-load")
    return _scd2(first, customer_refresh(spark, sf, raise_by=200), LOADS[2])


_TINY_SQL = """SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 0.0000001 ELSE c_acctbal END AS c_acctbal,
  c_mktsegment FROM customer"""


def _tiny_step(spark, sf, detect):
    c = table(spark, sf, "customer").select(*CUSTOMER_COLS)
    batch = c.withColumn("c_acctbal", F.when(
        F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + F.lit(0.0000001))
        .otherwise(F.col("c_acctbal")))
    return _scd2(customer_dimension(spark, sf), batch, AS_OF, detect=detect).drop("hash_key")


def _tiny_sql(detect):
    return (f"SELECT {_COLS}, cur_rec_ind, start_date, end_date FROM "
            f"({_scd2_sql(_dim_sql(), _TINY_SQL, AS_OF, detect)})")


@register("i9_scd2_hash_small_changes", _tiny_sql("columns"))
def i9_scd2_hash_small_changes(spark, sf):
    # doubles that differ in the seventh decimal: the fingerprint sees what
    # a comparison of the columns sees
    return _tiny_step(spark, sf, "hash")


# ---------------------------------------------------------------------------
# sources that a merge must take apart: keys alike only after the cast, NULL
# keys, keys that the target lacks and the other way round, target rows that
# share a key

@register("i3_merge_text_keys_deduped", _SCD1_SQL)
def i3_merge_text_keys_deduped(spark, sf):
    # two extracts, keys as text with and without leading zeros: cast, keep
    # the newer row of each key, merge
    batch = customer_refresh(spark, sf)
    text = F.col("c_custkey").cast("string")
    older = batch.withColumn("c_custkey", text).withColumn("c_name", F.lit("old")).withColumn(
        "extract", F.lit(1))
    newer = batch.withColumn("c_custkey", F.lpad(text, 12, "0")).withColumn("extract", F.lit(2))
    both = older.unionByName(newer).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))
    latest = mg.dedupe_latest(both, ["c_custkey"], "extract").drop("extract")
    return mg.merge(table(spark, sf, "customer"), latest, "c_custkey", update="*", insert="*")


@register("i3_merge_null_and_missing_keys", f"""
WITH r AS (SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_custkey END AS c_custkey,
                  c_name, c_nationkey, c_acctbal, c_mktsegment
           FROM ({_refresh_sql()}) WHERE c_mktsegment <> 'FURNITURE')
SELECT * FROM r
UNION ALL SELECT * FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.c_custkey = c.c_custkey)""")
def i3_merge_null_and_missing_keys(spark, sf):
    # many source rows without a key are inserted; FURNITURE and AUTOMOBILE
    # customers have no source row and stay as they are
    r = customer_refresh(spark, sf).filter(F.col("c_mktsegment") != "FURNITURE").withColumn(
        "c_custkey", F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_custkey")))
    return mg.merge(table(spark, sf, "customer"), r, "c_custkey", update="*", insert="*",
                    null_keys="insert")


@register("i1_upsert_many_rows_per_key", """
WITH s AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'FURNITURE')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       COALESCE(s.c_mktsegment, o_orderpriority) AS o_orderpriority
FROM orders LEFT JOIN s ON o_custkey = s.c_custkey
UNION ALL
SELECT NULL, c_custkey, 'N', NULL, NULL, c_mktsegment FROM s
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = s.c_custkey)""")
def i1_upsert_many_rows_per_key(spark, sf):
    # a target with many rows of each key: all of them are updated
    s = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "FURNITURE").select(
        "c_custkey", "c_mktsegment")
    return mg.merge(table(spark, sf, "orders"), s, {"o_custkey": "c_custkey"},
                    update={"o_orderpriority": "source.c_mktsegment"},
                    insert={"o_custkey": "source.c_custkey", "o_orderstatus": F.lit("N"),
                            "o_orderpriority": "source.c_mktsegment"})


@register("i14_insert_rows_to_append", f"""
WITH r AS ({_refresh_sql()})
SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = r.c_custkey)""")
def i14_insert_rows_to_append(spark, sf):
    # only what an insert-only merge adds, for an append to the stored table
    return mg.insert_rows(table(spark, sf, "customer"), customer_refresh(spark, sf), "c_custkey")


# ---------------------------------------------------------------------------
# a small feed into a large fact table (the daily-batch case)

_ORDER_UPSERT_SQL = """
WITH b AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'O' THEN 'F' WHEN 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 90 DAY FROM orders))
SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
       o.o_totalprice, o.o_orderdate, o.o_orderpriority
FROM orders o LEFT JOIN b ON o.o_orderkey = b.o_orderkey"""


def _order_upsert(spark, sf, strategy):
    return mg.merge(table(spark, sf, "orders"), order_status_updates(spark, sf), "o_orderkey",
                    update={"o_orderstatus": "source.o_orderstatus"}, strategy=strategy)


@register("i1_upsert_order_status_feed", _ORDER_UPSERT_SQL)
def i1_upsert_order_status_feed(spark, sf):
    # the feed is measured and, within the bounds, broadcast: the table
    # streams through one left join, unshuffled
    return _order_upsert(spark, sf, "broadcast")


@register("i1_upsert_order_status_feed_shuffle", _ORDER_UPSERT_SQL)
def i1_upsert_order_status_feed_shuffle(spark, sf):
    return _order_upsert(spark, sf, "shuffle")


# ---------------------------------------------------------------------------
# a feed into a partitioned table: only the partitions it touches are written

_MONTHLY = T.StructType().add("month", "string")


def _orders_by_month(spark, sf):
    """The orders as a table with a folder for each month; its path and schema."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-by-month")
    month = F.date_format("o_orderdate", "yyyy-MM")
    orders.withColumn("month", month).repartition("month").write.partitionBy("month").parquet(path)
    return path, T.StructType(orders.schema.fields + _MONTHLY.fields)


@register("i1_partitioned_status_feed", _ORDER_UPSERT_SQL)
def i1_partitioned_status_feed(spark, sf):
    path, schema = _orders_by_month(spark, sf)
    merge_partitions(spark, path, order_status_updates(spark, sf), "o_orderkey",
                     partition_by=["month"], update={"o_orderstatus": "source.o_orderstatus"},
                     schema=schema)
    return spark.read.schema(schema).parquet(path).drop("month")


_LATE_ORDERS_SQL = """
SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders) AS o_orderkey, o_custkey,
       'O' AS o_orderstatus, o_totalprice, o_orderdate + INTERVAL 40 DAY AS o_orderdate,
       o_orderpriority
FROM orders WHERE o_orderstatus = 'P'"""


@register("i3_partitioned_upsert", f"""
{_ORDER_UPSERT_SQL}
UNION ALL {_LATE_ORDERS_SQL}""")
def i3_partitioned_upsert(spark, sf):
    # status changes of the last months, and new orders in many months, some new
    orders = table(spark, sf, "orders")
    next_key = orders.select(F.max("o_orderkey") + 1).scalar()
    late = orders.filter("o_orderstatus = 'P'").withColumns({
        "o_orderkey": F.col("o_orderkey") + next_key, "o_orderstatus": F.lit("O"),
        "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")})
    feed = order_status_updates(spark, sf).unionByName(late, allowMissingColumns=True)
    feed = feed.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    path, schema = _orders_by_month(spark, sf)
    merge_partitions(spark, path, feed, "o_orderkey", partition_by=["month"],
                     update={"o_orderstatus": "source.o_orderstatus"}, insert="*", schema=schema)
    return spark.read.schema(schema).parquet(path).drop("month")


# ---------------------------------------------------------------------------
# a merge read through a filter and a join: its key check stays in the rows

@register("i3_merge_read_through_filter", f"""
SELECT m.c_custkey, m.c_acctbal, n_name FROM ({_SCD1_SQL}) m
JOIN nation ON m.c_nationkey = n_nationkey
WHERE m.c_mktsegment = 'AUTOMOBILE' AND m.c_custkey > 10""")
def i3_merge_read_through_filter(spark, sf):
    merged = mg.merge(table(spark, sf, "customer"), customer_refresh(spark, sf), "c_custkey",
                      update="*", insert="*")
    automobile = merged.filter((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_custkey") > 10))
    return automobile.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", "c_acctbal", "n_name")
