"""Checked queries: scalar functions (H): keys and fingerprints, text,
arrays and maps, dates, and the Arrow-batched user function."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions import collections as coll
from keelson.functions import dates
from keelson.functions.hashing import md5_key, row_hash
from keelson.functions.udf import month_year_label
from keelson.plans.catalog import register
from keelson.plans.inputs import AS_OF, table


# ---------------------------------------------------------------------------
# keys and fingerprints

@register("h1_md5_key", """
SELECT c_custkey, md5(CAST(c_nationkey AS VARCHAR)) AS nation_hash FROM customer""")
def h1_md5_key(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", md5_key("c_nationkey").alias("nation_hash"))


def _sql_field(expr: str) -> str:
    return f"COALESCE(CAST(length({expr}) AS VARCHAR) || ':' || {expr}, '~')"


_ROW_HASH_SQL = "md5(concat_ws('|', " + ", ".join(_sql_field(e) for e in [
    "CAST(c_custkey AS VARCHAR)", "c_name", "CAST(c_nationkey AS VARCHAR)",
    "CAST(c_acctbal AS VARCHAR)", "NULLIF(c_mktsegment, 'BUILDING')"]) + "))"


@register("h4_row_hash", f"""
SELECT c_custkey, {_ROW_HASH_SQL} AS row_hash,
       md5(concat_ws('_', CAST(c_custkey AS VARCHAR), c_name, NULLIF(c_mktsegment, 'BUILDING')))
         AS compat_hash
FROM customer""")
def h4_row_hash(spark, sf):
    c = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return c.select("c_custkey", row_hash(cols, c.schema).alias("row_hash"),
                    row_hash(["c_custkey", "c_name", "c_mktsegment"], compat=True)
                    .alias("compat_hash"))


def _sql_nested(kind: str, *fields: str) -> str:
    return f"'{kind[0]}' || " + " || '|' || ".join(fields) + f" || '{kind[1]}'"


_NESTED_SQL = ", ".join(_sql_field("(" + text + ")") for text in (
    _sql_nested("[]", _sql_field("CAST(o_custkey AS VARCHAR)"), "'~'",
                _sql_field("CAST(o_orderkey AS VARCHAR)")),
    _sql_nested("()", _sql_field("o_orderstatus"), _sql_field("CAST(o_totalprice AS VARCHAR)")),
    _sql_nested("{}", "'1:k=' || " + _sql_field("o_orderpriority"), "'2:at=' || " + _sql_field(
        "CAST(epoch_us(o_orderdate) AS VARCHAR)")),
    "'[]'"))


@register("h4_row_hash_nested",
          f"SELECT o_orderkey, md5(concat_ws('|', {_NESTED_SQL}, '~')) AS row_hash FROM orders")
def h4_row_hash_nested(spark, sf):
    # an array, a struct, a map whose entries come in any order, an empty array, no array
    o = table(spark, sf, "orders")
    at = F.unix_micros(F.to_utc_timestamp("o_orderdate", F.current_timezone())).cast("string")
    rows = o.select(
        "o_orderkey", F.array("o_custkey", F.lit(None), "o_orderkey").alias("a"),
        F.struct("o_orderstatus", "o_totalprice").alias("s"),
        F.create_map(F.lit("at"), at, F.lit("k"), F.col("o_orderpriority")).alias("m"),
        F.array().cast("array<string>").alias("e"), F.lit(None).cast("array<string>").alias("n"))
    return rows.select("o_orderkey", row_hash(["a", "s", "m", "e", "n"], rows.schema).alias("row_hash"))


# ---------------------------------------------------------------------------
# text

@register("h2_h3_concat", """
SELECT c_custkey,
       concat_ws('_', c_name, NULLIF(c_mktsegment, 'BUILDING')) AS name_segment,
       c_name || '-' || NULLIF(c_mktsegment, 'BUILDING') AS name_dash_segment
FROM customer""")
def h2_h3_concat(spark, sf):
    c = table(spark, sf, "customer")
    seg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return c.select("c_custkey", F.concat_ws("_", "c_name", seg).alias("name_segment"),
                    F.concat(F.col("c_name"), F.lit("-"), seg).alias("name_dash_segment"))


# ---------------------------------------------------------------------------
# arrays and maps

@register("h5_h6_split_explode", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def h5_h6_split_explode(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.explode(coll.split_to_array("p_name", " ")).alias("word"))


@register("h7_array_contains", """
SELECT p_partkey, list_contains(string_split(p_name, ' '), 'red') AS has_red FROM part""")
def h7_array_contains(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey",
                    F.array_contains(coll.split_to_array("p_name", " "), "red").alias("has_red"))


@register("h8_arrays_zip", """
SELECT p_partkey,
       list_transform(string_split(p_name, ' '), lambda w: w || '=' || CAST(length(w) AS VARCHAR))
         AS word_lengths
FROM part""")
def h8_arrays_zip(spark, sf):
    p = table(spark, sf, "part").withColumn("words", coll.split_to_array("p_name", " "))
    p = p.withColumn("lens", F.transform("words", lambda w: F.length(w)))
    zipped = coll.zip_arrays("words", "lens")
    return p.select("p_partkey", F.transform(
        zipped, lambda z: F.concat(z["words"], F.lit("="), z["lens"].cast("string")))
        .alias("word_lengths"))


@register("h9_h10_map_from_entries", """
SELECT p_partkey,
       list_sort(list_distinct(string_split(p_name, ' '))) AS word_keys,
       list_transform(list_sort(list_distinct(string_split(p_name, ' '))), lambda w: CAST(length(w) AS INTEGER))
         AS word_values,
       CAST(length(split_part(p_name, ' ', 1)) AS INTEGER) AS first_word_len
FROM part""")
def h9_h10_map_from_entries(spark, sf):
    p = table(spark, sf, "part").withColumn("words", coll.split_to_array("p_name", " "))
    p = p.withColumn("m", coll.zip_to_map("words", F.transform("words", lambda w: F.length(w))))
    keys = coll.sorted_map_keys("m")
    return p.select("p_partkey", keys.alias("word_keys"),
                    F.transform(keys, lambda k: F.col("m")[k]).alias("word_values"),
                    F.col("m")[F.col("words")[0]].alias("first_word_len"))


@register("h11_create_map_array", """
SELECT c_custkey, [c_name, c_mktsegment] AS name_segment,
       c_mktsegment AS segment_from_map,
       list_sort(['name', c_mktsegment]) AS map_keys_sorted,
       list_sort([c_name, c_mktsegment]) AS map_values_sorted
FROM customer""")
def h11_create_map_array(spark, sf):
    c = table(spark, sf, "customer")
    m = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"))
    by_segment = F.create_map(F.col("c_mktsegment"), F.col("c_mktsegment"), F.lit("name"),
                              F.col("c_name"))
    return c.select("c_custkey", F.array("c_name", "c_mktsegment").alias("name_segment"),
                    m["segment"].alias("segment_from_map"),
                    coll.sorted_map_keys(by_segment).alias("map_keys_sorted"),
                    coll.sorted_map_values(by_segment).alias("map_values_sorted"))


# ---------------------------------------------------------------------------
# dates (processing date fixed: AS_OF)

@register("h12_parse_date", """
SELECT o_orderkey,
       CAST(try_strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS parsed,
       CAST(try_strptime(o_orderstatus, '%d-%m-%Y') AS DATE) AS unparsable
FROM orders""")
def h12_parse_date(spark, sf):
    o = table(spark, sf, "orders")
    text = F.date_format("o_orderdate", "dd-MM-yyyy")
    return o.select("o_orderkey", dates.parse_date(text, "dd-MM-yyyy").alias("parsed"),
                    dates.parse_date("o_orderstatus", "dd-MM-yyyy").alias("unparsable"))


@register("h13_date_format", """
SELECT o_orderkey, strftime(o_orderdate, '%b-%Y') AS month_label FROM orders""")
def h13_date_format(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.format_date("o_orderdate", "MMM-yyyy").alias("month_label"))


@register("h14_days_between", f"""
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER)
       AS days_since_order
FROM orders""")
def h14_days_between(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.days_between(
        dates.as_of_date(AS_OF), F.col("o_orderdate").cast("date")).alias("days_since_order"))


_MB = f"""(year(DATE '{AS_OF}') - year(d)) * 12 + month(DATE '{AS_OF}') - month(d)"""


@register("h15_months_between", f"""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey,
       CASE WHEN day(d) = day(DATE '{AS_OF}')
              OR (d = last_day(d) AND DATE '{AS_OF}' = last_day(DATE '{AS_OF}'))
            THEN CAST({_MB} AS DOUBLE)
            ELSE round({_MB} + (day(DATE '{AS_OF}') - day(d)) / 31.0, 8) END AS months_since_order
FROM o""")
def h15_months_between(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.months_between(
        dates.as_of_date(AS_OF), F.col("o_orderdate").cast("date")).alias("months_since_order"))


@register("h16_add_days", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 DAY AS DATE) AS due_date FROM orders""")
def h16_add_days(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.add_days(F.col("o_orderdate").cast("date"), 2)
                    .alias("due_date"))


@register("h17_add_months", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH AS DATE) AS two_months_before
FROM orders""")
def h17_add_months(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.add_months(F.col("o_orderdate").cast("date"), -2)
                    .alias("two_months_before"))


@register("h18_month", "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders")
def h18_month(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.month_of("o_orderdate").alias("order_month"))


@register("h20_udf_month_label", """
SELECT o_orderkey, strftime(o_orderdate, '%b-%Y') AS month_label FROM orders""")
def h20_udf_month_label(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    month_year_label(F.col("o_orderdate").cast("date")).alias("month_label"))
