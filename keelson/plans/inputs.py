"""Inputs of the registered queries, all derived by Spark from the given tables.

Every derived input covers whole tables and grows with them; the rules that
pick changed or malformed rows are data rules (a market segment, a sign, a
nation), never id ranges or samples.

- ``customer_refresh``: the next extract of the customer master. BUILDING
  customers' balances rise by 100.00; MACHINERY customers with a negative
  balance move to AUTOMOBILE; every supplier is onboarded as a new customer
  (key = supplier key + the largest customer key + 1); all other customers
  arrive unchanged.
- ``customer_feed_csv``: the customer table as a header-less CSV feed with
  the defects a real feed has: negative balances in accounting notation
  "(12.34)" (a type error), a trailing extra field on every row of nation 3
  (too long), and the segment missing on AUTOMOBILE rows with a balance over
  9500 (too short).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed processing dates of the registered queries (never the clock).
INITIAL_LOAD = "2025-07-28"
AS_OF = "2025-07-29"
SECOND_AS_OF = "2025-07-30"

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_SCHEMA = ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                   "c_mktsegment string")


_READERS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given (read-only) table. The reader DataFrame is kept per session
    and path, as a catalog keeps a table's metadata: its file listing and
    parquet schema are resolved once, not on every query that reads it."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _READERS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READERS[key] = spark.read.parquet(path)
    return df


def money(c) -> F.Column:
    """A double amount as exact cents (decimal(18,2))."""
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def customer_refresh(spark: SparkSession, sf_dir: str, raise_by: int = 100) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(*CUSTOMER_COLS)
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    changed = customer.select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(seg == "BUILDING", (money(bal) + F.lit(raise_by)).cast("double"))
         .otherwise(bal).alias("c_acctbal"),
        F.when((seg == "MACHINERY") & (bal < 0), F.lit("AUTOMOBILE"))
         .otherwise(seg).alias("c_mktsegment"))
    if raise_by != 100:
        return changed
    next_key = customer.select(F.max("c_custkey") + 1).scalar()
    onboarded = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + next_key).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"))
    return changed.unionByName(onboarded)


def customer_feed_lines(spark: SparkSession, sf_dir: str,
                        rows: DataFrame | None = None) -> DataFrame:
    """The feed's lines as one text column ``value`` (of other customer rows
    when ``rows`` is given)."""
    c = table(spark, sf_dir, "customer") if rows is None else rows
    bal = F.col("c_acctbal")
    bal_text = F.when(bal < 0, F.concat(F.lit("("), money(-bal).cast("string"), F.lit(")"))) \
                .otherwise(money(bal).cast("string"))
    short = (F.col("c_mktsegment") == "AUTOMOBILE") & (bal > 9500)
    fields = [F.col("c_custkey").cast("string"), F.col("c_name"),
              F.col("c_nationkey").cast("string"), bal_text]
    line = F.when(short, F.concat_ws(",", *fields)) \
            .otherwise(F.concat_ws(",", *fields, F.col("c_mktsegment")))
    line = F.when(F.col("c_nationkey") == 3, F.concat(line, F.lit(",legacy"))).otherwise(line)
    return c.select(line.alias("value"))


def customer_feed_csv(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> str:
    """Write the feed under the shared scratch folder; returns its path."""
    path = scratch_path(spark, "customer-feed")
    customer_feed_lines(spark, sf_dir, rows).write.text(path)
    return path


def nation_csv(spark: SparkSession, sf_dir: str) -> str:
    """``nation`` written as CSV with a header line per file."""
    path = scratch_path(spark, "nation-csv")
    table(spark, sf_dir, "nation").write.option("header", True).csv(path)
    return path


def order_status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's status feed for the order fact table: every order placed in
    the 90 days up to the newest order advances one status (O -> F, P -> O).
    A batch small next to the table it updates, as a daily feed is."""
    orders = table(spark, sf_dir, "orders")
    since = orders.select(F.max("o_orderdate") - F.expr("INTERVAL 90 DAYS")).scalar()
    st = F.col("o_orderstatus")
    return orders.filter(F.col("o_orderdate") >= since).select(
        "o_orderkey", F.when(st == "O", "F").when(st == "P", "O").otherwise(st).alias("o_orderstatus"))
