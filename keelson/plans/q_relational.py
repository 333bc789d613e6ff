"""Checked queries: projection and predicates (B), joins (C), aggregation,
pivot and unpivot (D), ordering (E), unions (F) and layout (G).

Money sums go through decimal(18,2) and back to double on both sides, so
the Spark and SQL results are equal to the last bit whatever the order of
summation.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators import aggregate as agg
from keelson.operators import joins, layout, ordering, projection, setops
from keelson.plans.catalog import register
from keelson.plans.inputs import table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def money_sum(c: str):
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def _sql_money_sum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def american_nations(spark, sf):
    """The nations of region 1: the outer joins keep all customers, some of
    whom have no such nation, and the right side has rows without a match
    added (``+ 1000``: a nation that nobody lives in)."""
    n = table(spark, sf, "nation").filter(F.col("n_regionkey") == 1)
    return n.unionByName(n.withColumn("n_nationkey", F.col("n_nationkey") + 1000))


_AMERICAN_SQL = """(SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey = 1
  UNION ALL SELECT n_nationkey + 1000, n_name, n_regionkey FROM nation WHERE n_regionkey = 1)"""


# ---------------------------------------------------------------------------
# C10 / D6: join then group (the first end-to-end slice)

@register("c10_left_join_group_sum", f"""
SELECT n_name, {_sql_money_sum('c_acctbal')} AS sum_acctbal
FROM customer LEFT JOIN {_AMERICAN_SQL} ON c_nationkey = n_nationkey
GROUP BY n_name""")
def c10_left_join_group_sum(spark, sf):
    c, n = table(spark, sf, "customer"), american_nations(spark, sf)
    return joins.join_aggregate(c, n, c.c_nationkey == n.n_nationkey, "left",
                                ["n_name"], [money_sum("c_acctbal").alias("sum_acctbal")])


@register("d6_count_after_join", f"""
SELECT n_name, COUNT(*) AS count_of_customers
FROM customer LEFT JOIN {_AMERICAN_SQL} ON c_nationkey = n_nationkey
GROUP BY n_name""")
def d6_count_after_join(spark, sf):
    c, n = table(spark, sf, "customer"), american_nations(spark, sf)
    return joins.join_aggregate(c, n, c.c_nationkey == n.n_nationkey, "left",
                                ["n_name"], [F.count(F.lit(1)).alias("count_of_customers")])


# ---------------------------------------------------------------------------
# B: projection, predicates, conditionals

@register("b1_b6_filter_project", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'""")
def b1_b6_filter_project(spark, sf):
    # filter before select: the predicate column need not be projected
    c = table(spark, sf, "customer")
    return c.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@register("b2_derive_first", """
SELECT CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS DOUBLE) AS annual_bal, * FROM customer""")
def b2_derive_first(spark, sf):
    c = table(spark, sf, "customer")
    return projection.derive_first(
        c, "annual_bal", (F.col("c_acctbal").cast("decimal(18,2)") * 12).cast("double"))


@register("b3_add_column", """
SELECT *, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS DOUBLE) AS annual_bal FROM customer""")
def b3_add_column(spark, sf):
    c = table(spark, sf, "customer")
    return projection.add_column(
        c, "annual_bal", (F.col("c_acctbal").cast("decimal(18,2)") * 12).cast("double"))


@register("b4_replace_column", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders""")
def b4_replace_column(spark, sf):
    o = table(spark, sf, "orders")
    # matched case-insensitively; the column keeps its place
    return projection.replace_column(o, "O_ORDERDATE", F.col("o_orderdate").cast("date")) \
        .withColumnRenamed("O_ORDERDATE", "o_orderdate")


@register("b5_rename_columns", """
SELECT c_custkey, c_name, c_nationkey AS c_nation_number, c_acctbal, c_mktsegment FROM customer""")
def b5_rename_columns(spark, sf):
    return projection.rename_columns(table(spark, sf, "customer"),
                                     {"c_nationkey": "c_nation_number"})


@register("b7_b8_compare_and", """
SELECT * FROM events WHERE value > 40 AND event_type = 'click'""")
def b7_b8_compare_and(spark, sf):
    e = table(spark, sf, "events")
    return e.filter(projection.all_of(projection.compare("value", ">", 40, as_type="double"),
                                      F.col("event_type") == "click"))


@register("b9_isin", "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def b9_isin(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "O"))


@register("b11_b12_conditionals", """
SELECT c_custkey,
       CASE WHEN c_acctbal > 5000 THEN 'high_bal' ELSE 'low_bal' END AS bal_type,
       CASE WHEN c_nationkey = 0 THEN 'home' WHEN c_nationkey < 10 THEN 'near'
            WHEN c_nationkey < 20 THEN 'far' ELSE 'other' END AS distance
FROM customer""")
def b11_b12_conditionals(spark, sf):
    c = table(spark, sf, "customer")
    nk = F.col("c_nationkey")
    return c.select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 5000, "high_bal").otherwise("low_bal").alias("bal_type"),
        projection.label_by([(nk == 0, "home"), (nk < 10, "near"), (nk < 20, "far")],
                            "other").alias("distance"))


@register("b13_cast", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_name FROM customer""")
def b13_cast(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name")
    return projection.cast_columns(c, {"c_custkey": "int", "c_nationkey": "string"})


@register("b15_b16_scale", "SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer")
def b15_b16_scale(spark, sf):
    return projection.scale_columns(table(spark, sf, "customer"), ["c_acctbal"], 2,
                                    keep=["c_custkey"])


@register("b17_null_profile", """
WITH e AS (SELECT event_id, ts, user_id, NULLIF(event_type, 'error') AS event_type,
                  CASE WHEN value < 1 THEN NULL ELSE value END AS value, props FROM events)
SELECT COUNT(*) FILTER (WHERE event_id IS NULL) AS event_id,
       COUNT(*) FILTER (WHERE ts IS NULL) AS ts,
       COUNT(*) FILTER (WHERE user_id IS NULL) AS user_id,
       COUNT(*) FILTER (WHERE event_type IS NULL) AS event_type,
       COUNT(*) FILTER (WHERE value IS NULL) AS value,
       COUNT(*) FILTER (WHERE props IS NULL) AS props
FROM e""")
def b17_null_profile(spark, sf):
    e = table(spark, sf, "events")
    e = e.select("event_id", "ts", "user_id",
                 F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
                 F.when(F.col("value") < 1, None).otherwise(F.col("value")).alias("value"),
                 "props")
    return projection.null_profile(e)


# ---------------------------------------------------------------------------
# C: joins

def _by_shared_key(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "nationkey")
    n = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "nationkey")
    return c, n


@register("c1_inner_join_shared_key", """
SELECT c.c_nationkey AS nationkey, c_custkey, c_name, c_acctbal, c_mktsegment, n_name, n_regionkey
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def c1_inner_join_shared_key(spark, sf):
    c, n = _by_shared_key(spark, sf)
    return joins.join_on(c, n, "nationkey", "inner")


@register("c2_right_join_project", f"""
SELECT c_name, n_name FROM customer c RIGHT JOIN {_AMERICAN_SQL} n ON c.c_nationkey = n.n_nationkey""")
def c2_right_join_project(spark, sf):
    c, n = table(spark, sf, "customer"), american_nations(spark, sf)
    return joins.join_on(c, n, {"c_nationkey": "n_nationkey"}, "right").select("c_name", "n_name")


@register("c3_full_join_shared_key", f"""
SELECT COALESCE(c.c_nationkey, n.n_nationkey) AS nationkey, c_custkey, c_name, c_acctbal,
       c_mktsegment, n_name, n_regionkey
FROM customer c FULL OUTER JOIN {_AMERICAN_SQL} n ON c.c_nationkey = n.n_nationkey""")
def c3_full_join_shared_key(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "nationkey")
    n = american_nations(spark, sf).withColumnRenamed("n_nationkey", "nationkey")
    return joins.join_on(c, n, "nationkey", "full")


@register("c4_left_join_expression", f"""
SELECT * FROM customer c LEFT JOIN {_AMERICAN_SQL} n ON c.c_nationkey = n.n_nationkey""")
def c4_left_join_expression(spark, sf):
    c, n = table(spark, sf, "customer"), american_nations(spark, sf)
    return joins.join_on(c, n, c.c_nationkey == n.n_nationkey, "left")


_IN_CREDIT_SQL = f"""customer c %s JOIN {_AMERICAN_SQL} n
  ON c.c_nationkey = n.n_nationkey AND c.c_acctbal > 0 AND n.n_name <> c.c_mktsegment"""


def _in_credit(spark, sf, how):
    """Joined by an expression: an equality, a condition of one side and one of
    both; some rows of either side match nothing."""
    c, n = table(spark, sf, "customer"), american_nations(spark, sf)
    on = (c.c_nationkey == n.n_nationkey) & (c.c_acctbal > 0) & (n.n_name != c.c_mktsegment)
    return joins.join_on(c, n, on, how)


@register("c3_full_join_expression", f"SELECT * FROM {_IN_CREDIT_SQL % 'FULL OUTER'}")
def c3_full_join_expression(spark, sf):
    return _in_credit(spark, sf, "full")


@register("c2_right_join_expression", f"SELECT * FROM {_IN_CREDIT_SQL % 'RIGHT'}")
def c2_right_join_expression(spark, sf):
    return _in_credit(spark, sf, "right")


_URGENT = "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"


def _urgent_orders(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")


@register("c5_left_semi", f"""
SELECT * FROM customer c WHERE EXISTS (SELECT 1 FROM {_URGENT} o WHERE o.o_custkey = c.c_custkey)""")
def c5_left_semi(spark, sf):
    c, o = table(spark, sf, "customer"), _urgent_orders(spark, sf)
    return joins.semi_join(c, o, {"c_custkey": "o_custkey"})


@register("c6_left_anti", f"""
SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM {_URGENT} o WHERE o.o_custkey = c.c_custkey)""")
def c6_left_anti(spark, sf):
    c, o = table(spark, sf, "customer"), _urgent_orders(spark, sf)
    return joins.semi_join(c, o, {"c_custkey": "o_custkey"}, anti=True)


@register("c7_self_semi", """
SELECT * FROM customer a WHERE EXISTS (SELECT 1 FROM customer b WHERE b.c_nationkey = a.c_custkey)""")
def c7_self_semi(spark, sf):
    # a table joined to itself on two of its columns, whole on both sides
    c = table(spark, sf, "customer")
    return joins.semi_join(c, c, {"c_custkey": "c_nationkey"})


@register("c7_self_anti", """
SELECT * FROM customer a WHERE NOT EXISTS (SELECT 1 FROM customer b WHERE b.c_nationkey = a.c_custkey)""")
def c7_self_anti(spark, sf):
    c = table(spark, sf, "customer")
    return joins.semi_join(c, c, {"c_custkey": "c_nationkey"}, anti=True)


@register("c8_hash_key_join", """
SELECT c.*, md5(CAST(c.c_nationkey AS VARCHAR)) AS hash_key, n.n_nationkey, n.n_name, n.n_regionkey
FROM customer c JOIN nation n ON md5(CAST(c.c_nationkey AS VARCHAR)) = md5(CAST(n.n_nationkey AS VARCHAR))""")
def c8_hash_key_join(spark, sf):
    return joins.hash_key_join(table(spark, sf, "customer"), table(spark, sf, "nation"),
                               {"c_nationkey": "n_nationkey"})


@register("c8_hash_key_full_join_null_keys", """
WITH a AS (SELECT c_nationkey AS k1, NULLIF(c_mktsegment, 'BUILDING') AS k2, COUNT(*) AS n_customers
           FROM customer GROUP BY 1, 2),
     b AS (SELECT s_nationkey AS k1, CASE WHEN s_acctbal < 0 THEN NULL ELSE 'MACHINERY' END AS k2,
                  COUNT(*) AS n_suppliers FROM supplier GROUP BY 1, 2)
SELECT COALESCE(a.k1, b.k1) AS k1, COALESCE(a.k2, b.k2) AS k2, n_customers, n_suppliers
FROM a FULL OUTER JOIN b ON a.k1 = b.k1 AND a.k2 = b.k2""")
def c8_hash_key_full_join_null_keys(spark, sf):
    # two keys of which one may be NULL: such rows match nothing on either side
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    a = c.groupBy(F.col("c_nationkey").alias("k1"),
                  F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("k2")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    b = s.groupBy(F.col("s_nationkey").alias("k1"),
                  F.when(F.col("s_acctbal") >= 0, "MACHINERY").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    return joins.hash_key_join(a, b, ["k1", "k2"], "full").drop("hash_key")


@register("c8_hash_key_join_mixed_types", """
SELECT c_custkey, n_name FROM customer FULL OUTER JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT c_custkey, n_name FROM customer JOIN nation
ON CAST(c_nationkey AS DECIMAL(9,2)) = CAST(n_nationkey AS DECIMAL(12,5))""")
def c8_hash_key_join_mixed_types(spark, sf):
    # an integer key against doubles, where 0 is written -0.0, and decimals of two scales
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    doubles = n.withColumn("n_nationkey", -(-F.col("n_nationkey").cast("double")))
    doubles = doubles.withColumn("n_nationkey", F.when(
        F.col("n_nationkey") == 0, F.lit(-0.0)).otherwise(F.col("n_nationkey")))
    wide = joins.hash_key_join(c, doubles, {"c_nationkey": "n_nationkey"}, "full")
    exact = joins.hash_key_join(
        c.withColumn("c_nationkey", F.col("c_nationkey").cast("decimal(9,2)")),
        n.withColumn("n_nationkey", F.col("n_nationkey").cast("decimal(12,5)")),
        {"c_nationkey": "n_nationkey"})
    return wide.select("c_custkey", "n_name").union(exact.select("c_custkey", "n_name"))


@register("c11_semi_for_inner_with_predicate", """
SELECT c.* FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)""")
def c11_semi_for_inner_with_predicate(spark, sf):
    # "select c.* from c join o on ... where <o predicate>" without the fan-out
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders").filter(F.col("o_totalprice") > 450000)
    return joins.semi_join(c, o, {"c_custkey": "o_custkey"})


# ---------------------------------------------------------------------------
# D: aggregation, collection, pivot, unpivot, distinct

@register("d1_group_sum", f"""
SELECT c_nationkey, {_sql_money_sum('c_acctbal')} AS sum_acctbal FROM customer GROUP BY c_nationkey""")
def d1_group_sum(spark, sf):
    return agg.grouped(table(spark, sf, "customer"), ["c_nationkey"],
                       [money_sum("c_acctbal").alias("sum_acctbal")])


@register("d2_group_count_sum", f"""
SELECT c_mktsegment, COUNT(*) AS n_customers, {_sql_money_sum('c_acctbal')} AS sum_acctbal
FROM customer GROUP BY c_mktsegment""")
def d2_group_count_sum(spark, sf):
    return agg.grouped(table(spark, sf, "customer"), ["c_mktsegment"],
                       [F.count(F.lit(1)).alias("n_customers"),
                        money_sum("c_acctbal").alias("sum_acctbal")])


@register("d3_d12_global_agg", f"""
SELECT COUNT(*) AS count_data, {_sql_money_sum('l_extendedprice')} AS sum_price FROM lineitem""")
def d3_d12_global_agg(spark, sf):
    return agg.grouped(table(spark, sf, "lineitem"), [],
                       [F.count(F.lit(1)).alias("count_data"),
                        money_sum("l_extendedprice").alias("sum_price")])


@register("d4_collect_list", """
SELECT o_custkey, list_sort(list(o_orderstatus) FILTER (WHERE o_orderstatus IS NOT NULL))
       AS o_orderstatus_list
FROM orders GROUP BY o_custkey""")
def d4_collect_list(spark, sf):
    return agg.collect_values(table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus")


@register("d5_collect_set", """
SELECT c_nationkey, list_sort(list(DISTINCT c_mktsegment) FILTER (WHERE c_mktsegment IS NOT NULL))
       AS c_mktsegment_set
FROM customer GROUP BY c_nationkey""")
def d5_collect_set(spark, sf):
    return agg.collect_values(table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment",
                              distinct=True)


def _chunks_sql(source: str, size: int, name: str) -> str:
    return f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY hot, o_orderstatus ORDER BY o_custkey) - 1 AS i
           FROM ({source}))
SELECT hot, o_orderstatus, i // {size} AS chunk, list(o_custkey ORDER BY o_custkey) AS {name}
FROM r GROUP BY hot, o_orderstatus, i // {size}"""


def _hot_orders(spark, sf):
    """Orders by status, those of every third customer as one group without a name."""
    o = table(spark, sf, "orders")
    hot = F.col("o_custkey") % 3 == 0
    return o.select(hot.alias("hot"), F.when(~hot, F.col("o_orderstatus")).alias("o_orderstatus"),
                    "o_custkey")


_HOT_ORDERS = """SELECT o_custkey % 3 = 0 AS hot,
  CASE WHEN o_custkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus, o_custkey FROM orders"""


@register("d4_collect_chunks", _chunks_sql(_HOT_ORDERS, 700, "o_custkey_list"))
def d4_collect_chunks(spark, sf):
    # lists of 700 values; a group of a third of the rows has as many as it needs
    return agg.collect_chunks(_hot_orders(spark, sf), ["hot", "o_orderstatus"], "o_custkey", 700)


@register("d5_collect_chunks_distinct", _chunks_sql(
    f"SELECT DISTINCT * FROM ({_HOT_ORDERS})", 100, "o_custkey_set"))
def d5_collect_chunks_distinct(spark, sf):
    return agg.collect_chunks(_hot_orders(spark, sf), ["hot", "o_orderstatus"], "o_custkey", 100,
                              distinct=True)


@register("d4_value_counts", """
SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus""")
def d4_value_counts(spark, sf):
    return agg.value_counts(table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus")


def _pivot_sql(index: str, col: str, values, agg_sql: str, source: str) -> str:
    cols = ", ".join(
        f"{agg_sql.format(cond=f'{col} = {v!r}')} AS \"{v}\"" for v in values)
    return f"SELECT {index}, {cols} FROM {source} GROUP BY {index}"


@register("d7_pivot_count", _pivot_sql(
    "c_nationkey", "c_mktsegment", SEGMENTS, "NULLIF(COUNT(*) FILTER (WHERE {cond}), 0)", "customer"))
def d7_pivot_count(spark, sf):
    return agg.pivot(table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment",
                     F.count(F.lit(1)), SEGMENTS)


@register("d8_pivot_sum", _pivot_sql(
    "c_nationkey", "c_mktsegment", SEGMENTS,
    "CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) FILTER (WHERE {cond}) AS DOUBLE)", "customer"))
def d8_pivot_sum(spark, sf):
    return agg.pivot(table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment",
                     money_sum("c_acctbal"), SEGMENTS)


@register("d9_pivot_mean", _pivot_sql(
    "p_brand", "p_type", PART_TYPES, "AVG(p_size) FILTER (WHERE {cond})", "part"))
def d9_pivot_mean(spark, sf):
    return agg.pivot(table(spark, sf, "part"), ["p_brand"], "p_type", F.avg("p_size"), PART_TYPES)


@register("d10_pivot_month_count", _pivot_sql(
    "order_month", "o_orderpriority", PRIORITIES, "NULLIF(COUNT(*) FILTER (WHERE {cond}), 0)",
    "(SELECT CAST(month(o_orderdate) AS INTEGER) AS order_month, o_orderpriority FROM orders)"))
def d10_pivot_month_count(spark, sf):
    o = table(spark, sf, "orders").select(F.month("o_orderdate").alias("order_month"),
                                          "o_orderpriority")
    return agg.pivot(o, ["order_month"], "o_orderpriority", F.count(F.lit(1)), PRIORITIES)


@register("d7_pivot_count_others", _pivot_sql(
    "c_nationkey", "c_mktsegment", SEGMENTS[:3], "NULLIF(COUNT(*) FILTER (WHERE {cond}), 0)",
    "customer").replace(" FROM customer", f""",
       NULLIF(COUNT(*) FILTER (WHERE c_mktsegment NOT IN {tuple(SEGMENTS[:3])}), 0) AS "other"
FROM customer"""))
def d7_pivot_count_others(spark, sf):
    # rows with values beyond the list land in a column of their own
    return agg.pivot(table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment",
                     F.count(F.lit(1)), SEGMENTS[:3], others="column")


_BY_PRIORITY = _pivot_sql(
    "o_custkey", "o_orderpriority", PRIORITIES,
    "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE {cond}) AS DOUBLE)", "orders")


def _by_priority(spark, sf):
    """A customer's order sums by priority: NULL where there is no order."""
    return agg.pivot(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority",
                     money_sum("o_totalprice"), PRIORITIES)


@register("d11_unpivot_keep_nulls", "WITH p AS (" + _BY_PRIORITY + ") " + " UNION ALL ".join(
    f"SELECT o_custkey, '{s}' AS o_orderpriority, \"{s}\" AS sum_price FROM p" for s in PRIORITIES))
def d11_unpivot_keep_nulls(spark, sf):
    return agg.unpivot(_by_priority(spark, sf), ["o_custkey"], PRIORITIES, "o_orderpriority",
                       "sum_price")


@register("d11_unpivot_drop_nulls", "WITH p AS (" + _BY_PRIORITY + ") SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT o_custkey, '{s}' AS o_orderpriority, \"{s}\" AS sum_price FROM p" for s in PRIORITIES)
    + ") WHERE sum_price IS NOT NULL")
def d11_unpivot_drop_nulls(spark, sf):
    return agg.unpivot(_by_priority(spark, sf), ["o_custkey"], PRIORITIES, "o_orderpriority",
                       "sum_price", include_nulls=False)


@register("d13_distinct", "SELECT DISTINCT c_mktsegment FROM customer")
def d13_distinct(spark, sf):
    return agg.distinct_values(table(spark, sf, "customer"), ["c_mktsegment"])


# ---------------------------------------------------------------------------
# E: ordering (the oracle compares rows, not order; tests check the order)

@register("e1_sort_multi_key", "SELECT * FROM customer ORDER BY c_nationkey ASC, c_acctbal DESC")
def e1_sort_multi_key(spark, sf):
    return ordering.sort_by(table(spark, sf, "customer"), ["c_nationkey", "c_acctbal"],
                            [True, False])


@register("e2_sort_asc", "SELECT * FROM customer ORDER BY c_acctbal ASC")
def e2_sort_asc(spark, sf):
    return ordering.sort_by(table(spark, sf, "customer"), ["c_acctbal"])


@register("e3_sort_desc", "SELECT * FROM customer ORDER BY c_name DESC")
def e3_sort_desc(spark, sf):
    return ordering.sort_by(table(spark, sf, "customer"), ["c_name"], False)


@register("e4_top_n", """
SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey ASC LIMIT 10""")
def e4_top_n(spark, sf):
    return ordering.top_n(table(spark, sf, "customer"), ["c_acctbal", "c_custkey"], 10,
                          [False, True])


# ---------------------------------------------------------------------------
# F: unions

@register("f1_f2_union_all", """
SELECT c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def f1_f2_union_all(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return setops.union_all(c, s)


@register("f3_union_by_name", """
SELECT c_custkey AS party_key, c_name AS party_name FROM customer
UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def f3_union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("party_key"),
                                            F.col("c_name").alias("party_name"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("party_name"),
                                            F.col("s_suppkey").alias("party_key"))
    return setops.union_by_name(c, s)


@register("f4_union_by_name_missing", "SELECT * FROM customer UNION ALL BY NAME SELECT * FROM nation")
def f4_union_by_name_missing(spark, sf):
    return setops.union_by_name(table(spark, sf, "customer"), table(spark, sf, "nation"),
                                allow_missing=True)


# ---------------------------------------------------------------------------
# G: layout. Partition ids and sizes follow Spark's hash and sampled bounds; the
# queries return what must hold of them whatever these are.

@register("g1_g2_round_robin_profile", """
SELECT 8 AS n_partitions, COUNT(*) AS n_rows, TRUE AS is_even FROM lineitem""")
def g1_g2_round_robin_profile(spark, sf):
    laid = layout.lay_out(table(spark, sf, "lineitem"), "round_robin", 8)
    return layout.partition_profile(laid).agg(
        F.count(F.lit(1)).alias("n_partitions"), F.sum("rows").alias("n_rows"),
        (F.max("rows") <= 2 * F.min("rows")).alias("is_even"))


@register("g3_hash_partition_profile", """
SELECT COUNT(*) AS n_rows, TRUE AS at_most_a_partition_a_key FROM customer""")
def g3_hash_partition_profile(spark, sf):
    laid = layout.lay_out(table(spark, sf, "customer"), "hash", 8, ["c_mktsegment"])
    return layout.partition_profile(laid).agg(
        F.sum("rows").alias("n_rows"),
        (F.count(F.lit(1)) <= len(SEGMENTS)).alias("at_most_a_partition_a_key"))


@register("g3_salted_hash_layout", """
SELECT c_mktsegment, COUNT(*) AS n_rows, TRUE AS within_salts FROM customer GROUP BY c_mktsegment""")
def g3_salted_hash_layout(spark, sf):
    # a key's rows dealt over up to four partitions, so a hot key is split
    laid = layout.with_partition_id(layout.lay_out(
        table(spark, sf, "customer"), "hash", 16, ["c_mktsegment"], salts=4))
    return laid.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("partition_id").between(1, 4).alias("within_salts"))


@register("g4_range_partition_profile", """
SELECT COUNT(*) AS n_rows, TRUE AS at_most_eight, TRUE AS is_disjoint FROM orders""")
def g4_range_partition_profile(spark, sf):
    laid = layout.lay_out(table(spark, sf, "orders"), "range", 8, ["o_orderdate"])
    parts = layout.range_profile(laid, "o_orderdate")  # a row for each of the eight
    before = F.lag("max_key").over(Window.orderBy("min_key"))
    return parts.withColumn("apart", F.coalesce(before < F.col("min_key"), F.lit(True))).agg(
        F.sum("rows").alias("n_rows"), (F.count(F.lit(1)) <= 8).alias("at_most_eight"),
        F.min("apart").alias("is_disjoint"))


@register("g5_coalesce_profile", """
SELECT COUNT(*) AS n_rows, TRUE AS at_most_four FROM lineitem""")
def g5_coalesce_profile(spark, sf):
    laid = layout.lay_out(layout.lay_out(table(spark, sf, "lineitem"), "round_robin", 8),
                          "coalesce", 4)
    return layout.partition_profile(laid).agg(
        F.sum("rows").alias("n_rows"), (F.count(F.lit(1)) <= 4).alias("at_most_four"))


@register("g2_round_robin_keeps_rows", """
SELECT 8 AS n_partitions, COUNT(*) AS n_rows FROM lineitem""")
def g2_round_robin_keeps_rows(spark, sf):
    # every row kept, spread over all 8 partitions
    laid = layout.with_partition_id(layout.lay_out(table(spark, sf, "lineitem"), "round_robin", 8))
    return laid.agg(F.count_distinct("partition_id").alias("n_partitions"),
                    F.count(F.lit(1)).alias("n_rows"))


@register("g3_hash_layout_colocates_keys", """
SELECT c_mktsegment, 1 AS n_partitions, COUNT(*) AS n_rows FROM customer GROUP BY c_mktsegment""")
def g3_hash_layout_colocates_keys(spark, sf):
    # all rows of a key in exactly one partition
    laid = layout.with_partition_id(
        layout.lay_out(table(spark, sf, "customer"), "hash", 8, ["c_mktsegment"]))
    return laid.groupBy("c_mktsegment").agg(
        F.count_distinct("partition_id").cast("int").alias("n_partitions"),
        F.count(F.lit(1)).alias("n_rows"))


@register("g3_hot_key_layout", """
SELECT COUNT(*) AS n_rows, 0 AS over_twice_the_mean, 0 AS cold_keys_in_two_places,
       COUNT(DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END) AS n_keys
FROM orders""")
def g3_hot_key_layout(spark, sf):
    # one key holds a third of the rows: it is found and dealt, the others stay whole
    o = table(spark, sf, "orders").withColumn(
        "k", F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_custkey")))
    laid = layout.with_partition_id(layout.lay_out(o, "hash", 12, ["k"], salts="auto"))
    sizes = laid.groupBy("k", "partition_id").count()
    by_part = sizes.groupBy("partition_id").agg(F.sum("count").alias("n")).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("n") > 2 * F.lit(o.count() / 12), 1).otherwise(0)).cast("int")
        .alias("over_twice_the_mean"))
    by_key = sizes.groupBy("k").agg(F.count(F.lit(1)).alias("places")).agg(
        F.sum(F.when((F.col("k") != -1) & (F.col("places") > 1), 1).otherwise(0)).cast("int")
        .alias("cold_keys_in_two_places"), F.count(F.lit(1)).alias("n_keys"))
    return by_part.join(by_key, F.lit(True))  # one row each
