"""Checked queries: ingestion (A) — CSV modes over a feed derived from
``customer``, the schema contract, SQL over views, incremental batches.

The feed (see ``inputs.customer_feed_lines``) has three kinds of bad line;
``_BAD`` is the same rule in SQL and ``_LINE`` rebuilds the raw text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from keelson.plans.catalog import register
from keelson.plans.inputs import CUSTOMER_SCHEMA, customer_feed_csv, nation_csv, table
from keelson.session import scratch_path
from keelson.sources import csv_ingest, incremental, tables

_SHORT = "(c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 9500)"
_LONG = "(c_nationkey = 3)"
# a line both short and long has five fields again: it parses, with the
# trailing 'legacy' as its segment
_SEGMENT = (f"CASE WHEN {_SHORT} AND {_LONG} THEN 'legacy' WHEN {_SHORT} THEN NULL "
            f"ELSE c_mktsegment END")
_BAD = f"(c_acctbal < 0 OR ({_SHORT}) <> ({_LONG}))"
_GOOD_ROW = f"c_custkey, c_name, c_nationkey, c_acctbal, {_SEGMENT} AS c_mktsegment"
_BAL_TEXT = ("CASE WHEN c_acctbal < 0 THEN '(' || CAST(CAST(-c_acctbal AS DECIMAL(18,2)) AS VARCHAR)"
             " || ')' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END")
_LINE = (f"CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || CAST(c_nationkey AS VARCHAR) || ','"
         f" || {_BAL_TEXT} || CASE WHEN {_SHORT} THEN '' ELSE ',' || c_mktsegment END"
         f" || CASE WHEN c_nationkey = 3 THEN ',legacy' ELSE '' END")

TEXT_SCHEMA = ("c_custkey string, c_name string, c_nationkey string, c_acctbal string, "
               "c_mktsegment string")
CONTRACT = ("c_custkey bigint not null, c_name string, c_nationkey int, c_acctbal double, "
            "c_mktsegment string not null")


@register("a1_csv_header_all_strings", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
FROM nation""")
def a1_csv_header_all_strings(spark, sf):
    return csv_ingest.read_csv(spark, nation_csv(spark, sf), header=True, on_bad="null")


@register("a2_csv_infer_schema", "SELECT * FROM nation")
def a2_csv_infer_schema(spark, sf):
    return csv_ingest.read_csv(spark, nation_csv(spark, sf), header=True, infer_schema=True,
                               on_bad="null")


@register("a3_csv_explicit_schema", "SELECT * FROM nation")
def a3_csv_explicit_schema(spark, sf):
    return csv_ingest.read_csv(spark, nation_csv(spark, sf),
                               "n_nationkey int, n_name string, n_regionkey int",
                               header=True, on_bad="fail")


@register("a4_csv_permissive_nulls", f"""
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       {_SEGMENT} AS c_mktsegment
FROM customer""")
def a4_csv_permissive_nulls(spark, sf):
    return csv_ingest.read_csv(spark, customer_feed_csv(spark, sf), CUSTOMER_SCHEMA, on_bad="null")


@register("a5_csv_quarantine_good", f"SELECT {_GOOD_ROW} FROM customer WHERE NOT {_BAD}")
def a5_csv_quarantine_good(spark, sf):
    df = csv_ingest.read_csv(spark, customer_feed_csv(spark, sf), CUSTOMER_SCHEMA,
                             on_bad="quarantine")
    return csv_ingest.split_quarantine(df)[0]


@register("a5_csv_quarantine_bad", f"SELECT {_LINE} AS raw_line FROM customer WHERE {_BAD}")
def a5_csv_quarantine_bad(spark, sf):
    df = csv_ingest.read_csv(spark, customer_feed_csv(spark, sf), CUSTOMER_SCHEMA,
                             on_bad="quarantine")
    return csv_ingest.split_quarantine(df)[1]


@register("a6_csv_drop_count_by_segment", f"""
SELECT {_SEGMENT} AS c_mktsegment, COUNT(*) AS n_customers FROM customer WHERE NOT {_BAD}
GROUP BY 1""")
def a6_csv_drop_count_by_segment(spark, sf):
    # a one-column aggregate: without the all-columns guard DROPMALFORMED
    # would judge only c_mktsegment and drop almost nothing
    df = csv_ingest.read_csv(spark, customer_feed_csv(spark, sf), CUSTOMER_SCHEMA, on_bad="drop")
    return df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"))


@register("a7_csv_failfast_mended_feed", f"""
SELECT c_custkey, c_name, CASE WHEN c_nationkey = 3 THEN 4 ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_acctbal > 9500 THEN 9500.0 ELSE abs(c_acctbal) END AS c_acctbal, c_mktsegment
FROM customer""")
def a7_csv_failfast_mended_feed(spark, sf):
    # every customer, each fault mended: the strict mode reads the feed to its
    # end (tests: it raises on the faulty one)
    c = table(spark, sf, "customer")
    mended = c.withColumn("c_nationkey", F.when(F.col("c_nationkey") == 3, 4)
                          .otherwise(F.col("c_nationkey"))).withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") > 9500, 9500.0).otherwise(F.abs("c_acctbal")))
    return csv_ingest.read_csv(spark, customer_feed_csv(spark, sf, mended), CUSTOMER_SCHEMA,
                               on_bad="fail")


@register("a8_schema_contract_violations", f"""
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_nationkey,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       {_SEGMENT} AS c_mktsegment,
       list_filter([CASE WHEN c_acctbal < 0 THEN 'c_acctbal' END,
                    CASE WHEN {_SEGMENT} IS NULL THEN 'c_mktsegment' END], lambda x: x IS NOT NULL)
         AS _violations
FROM customer WHERE c_acctbal < 0 OR {_SEGMENT} IS NULL""")
def a8_schema_contract_violations(spark, sf):
    raw = csv_ingest.read_csv(spark, customer_feed_csv(spark, sf), TEXT_SCHEMA, on_bad="null")
    good, bad = csv_ingest.enforce(raw, CONTRACT, on_violation="quarantine")
    return bad


@register("a8_schema_contract_good", f"""
SELECT {_GOOD_ROW} FROM customer WHERE NOT (c_acctbal < 0 OR {_SEGMENT} IS NULL)""")
def a8_schema_contract_good(spark, sf):
    raw = csv_ingest.read_csv(spark, customer_feed_csv(spark, sf), TEXT_SCHEMA, on_bad="null")
    good, _ = csv_ingest.enforce(raw, CONTRACT, on_violation="quarantine")
    return good


@register("a13_view_sql", """
SELECT o_orderpriority, COUNT(*) AS n_orders FROM orders WHERE o_totalprice > 400000
GROUP BY o_orderpriority""")
def a13_view_sql(spark, sf):
    return tables.sql_over(spark, {"orders_view": table(spark, sf, "orders")}, """
        SELECT o_orderpriority, COUNT(*) AS n_orders FROM orders_view
        WHERE o_totalprice > 400000 GROUP BY o_orderpriority""")


@register("a14_incremental_new_rows", """
SELECT * FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')""")
def a14_incremental_new_rows(spark, sf):
    orders = table(spark, sf, "orders")
    loaded = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return incremental.new_rows(orders, loaded, "o_orderdate")


_LOADED_SQL = """(SELECT * FROM o WHERE o_orderdate IS NULL AND o_orderkey % 2 = 0 OR
  o_orderdate < TIMESTAMP '2000-01-01' AND NOT (o_orderpriority = '1-URGENT' AND o_orderdate =
    (SELECT max(o_orderdate) FROM o WHERE o_orderdate < TIMESTAMP '2000-01-01'
       AND o_orderpriority <> '1-URGENT')))"""


@register("a14_incremental_ties_and_nulls", f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
             CASE WHEN o_orderstatus <> 'P' THEN date_trunc('year', o_orderdate) END AS o_orderdate
           FROM orders),
     loaded AS {_LOADED_SQL}
SELECT * FROM o WHERE (o_orderdate IS NULL OR o_orderdate >= (SELECT max(o_orderdate) FROM loaded))
  AND NOT EXISTS (SELECT 1 FROM loaded WHERE loaded.o_orderkey = o.o_orderkey)""")
def a14_incremental_ties_and_nulls(spark, sf):
    # dates cut to the year, so many rows tie at the mark; one status has none
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.date_trunc("year", "o_orderdate"))
        .cast("timestamp_ntz").alias("o_orderdate"))
    before = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    mark = o.filter(before & ~urgent).select(F.max("o_orderdate")).scalar()
    loaded = o.filter((F.col("o_orderdate").isNull() & (F.col("o_orderkey") % 2 == 0))
                      | (before & ~(urgent & (F.col("o_orderdate") == mark))))
    return incremental.new_rows(o, loaded, "o_orderdate", keys=["o_orderkey"])


def _new_name(stem: str) -> str:
    return f"kt_{stem}_{uuid.uuid4().hex[:12]}"


@register("a9_a12_named_table_overwrite", "SELECT * FROM customer")
def a9_a12_named_table_overwrite(spark, sf):
    # a named table created (it must not exist yet), overwritten, read back
    name, customer = _new_name("customer"), table(spark, sf, "customer")
    tables.save_table(customer.filter(F.col("c_mktsegment") == "BUILDING"), name)
    tables.save_table(customer, name, mode="overwrite")
    return tables.read_table(spark, name)


@register("a10_a11_named_table_widened", """
SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS r_name FROM nation
UNION ALL
SELECT n_nationkey, n_name, NULL, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def a10_a11_named_table_widened(spark, sf):
    # rows appended with a column that the table lacks, and without one it has
    name, nation, region = _new_name("nation"), table(spark, sf, "nation"), table(spark, sf, "region")
    tables.save_table(nation.select("n_nationkey", "n_name", "n_regionkey"), name)
    more = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "r_name", "n_nationkey", "n_name")
    tables.save_table(more, name, mode="append", merge_schema=True)
    return tables.read_table(spark, name)


@register("a9_a12_snapshot_roundtrip", "SELECT * FROM customer")
def a9_a12_snapshot_roundtrip(spark, sf):
    # two committed versions under the shared scratch folder; the reader
    # takes the newest commit
    base = scratch_path(spark, "customer-snapshots")
    customer = table(spark, sf, "customer")
    tables.write_snapshot(customer.filter(F.col("c_mktsegment") == "BUILDING"), base, 1)
    tables.write_snapshot(customer, base, 2)
    return tables.read_snapshot(spark, base)


@register("a11_versions_with_added_column", """
SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS r_name FROM nation
UNION ALL
SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def a11_versions_with_added_column(spark, sf):
    base = scratch_path(spark, "nation-versions")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    v1 = tables.write_snapshot(nation, base, 1)
    v2 = tables.write_snapshot(nation.join(region, nation.n_regionkey == region.r_regionkey)
                               .select("n_nationkey", "n_name", "n_regionkey", "r_name"), base, 2)
    return tables.read_versions(spark, [v1, v2], merge_schema=True)


@register("a5_csv_ingest_once_good", f"SELECT {_GOOD_ROW} FROM customer WHERE NOT {_BAD}")
def a5_csv_ingest_once_good(spark, sf):
    # one parse of the feed, one partitioned write of both sides
    dest = csv_ingest.ingest_csv(spark, customer_feed_csv(spark, sf), CUSTOMER_SCHEMA,
                                 scratch_path(spark, "customer-ingested"))
    return csv_ingest.read_ingested(spark, dest)


@register("a5_csv_ingest_once_bad", f"SELECT {_LINE} AS raw_line FROM customer WHERE {_BAD}")
def a5_csv_ingest_once_bad(spark, sf):
    dest = csv_ingest.ingest_csv(spark, customer_feed_csv(spark, sf), CUSTOMER_SCHEMA,
                                 scratch_path(spark, "customer-ingested"))
    return csv_ingest.read_ingested(spark, dest, bad=True)
