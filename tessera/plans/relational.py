"""Relational plans: projections, filters, SQL clauses, lookups, set
operations and sorts (SURVEY §2.2, §2.3, §2.6, §2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import fround
from tessera.operators import ordered as O
from tessera.operators import relational as R
from tessera.plans.common import t
from tessera.plans.registry import plan


@plan("orders_projection", "PRJ-01", sql="""
SELECT o_orderkey, o_totalprice AS price, round(o_totalprice / 1000, 3) AS price_k, o_orderpriority
FROM orders""")
def orders_projection(spark, sf):
    o = t(spark, sf, "orders")
    return (o.withColumns({"price": F.col("o_totalprice"), "price_k": fround(F.col("o_totalprice") / 1000, 3)})
            .drop("o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
            .select("o_orderkey", "price", "price_k", "o_orderpriority"))


@plan("orders_positional_projection", "PRJ-02", sql="""
SELECT o_orderpriority, o_orderkey, o_orderstatus FROM orders""")
def orders_positional_projection(spark, sf):
    return R.select_positions(t(spark, sf, "orders"), [5, 0, 2])


@plan("orders_known_columns", "PRJ-03", sql="""
SELECT o_orderkey, o_totalprice FROM orders""")
def orders_known_columns(spark, sf):
    return R.select_known(t(spark, sf, "orders"), ["o_orderkey", "o_clerk", "o_totalprice"])


@plan("orders_optional_columns", "PRJ-04", sql="""
SELECT o_orderkey, o_orderstatus AS status, NULL::VARCHAR AS clerk FROM orders""")
def orders_optional_columns(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", R.optional_column(o, "o_orderstatus").alias("status"),
                    R.optional_column(o, "o_clerk").alias("clerk"))


@plan("orders_snake_case_names", "PRJ-05", sql="""
SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_totalprice AS order_total_price FROM orders""")
def orders_snake_case_names(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("orderKey"), F.col("o_custkey").alias("custKey"),
                                      F.col("o_totalprice").alias("totalPrice"))
    return R.rename_columns(o, overrides={"custKey": "customer_id"}, prefix={"totalPrice": "order"})


def _nested_orders(spark, sf):
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        "o_orderkey",
        F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
                 F.col("o_orderpriority").alias("priority")).alias("order"),
        F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                 F.col("c_mktsegment").alias("segment")).alias("customer"),
        F.split(F.concat_ws("|", "o_orderpriority", "o_orderstatus"), r"\|").alias("tags"))


_NESTED_SQL = """SELECT o_orderkey,
       {'key': o_orderkey, 'status': o_orderstatus, 'priority': o_orderpriority} AS "order",
       {'key': c_custkey, 'name': c_name, 'segment': c_mktsegment} AS customer,
       string_split(concat_ws('|', o_orderpriority, o_orderstatus), '|') AS tags
FROM orders JOIN customer ON o_custkey = c_custkey"""


@plan("order_nested_records", "PRJ-06 SCL-16 SCL-20", sql=f"""
SELECT o_orderkey, to_json({{'order': "order", 'customer': customer, 'tags': tags}})::VARCHAR AS record
FROM ({_NESTED_SQL})""")
def order_nested_records(spark, sf):
    n = _nested_orders(spark, sf)
    return n.select("o_orderkey", F.to_json(F.struct("order", "customer", "tags")).alias("record"))


@plan("nested_segment_filter", "FIL-03", sql=f"""
SELECT o_orderkey, customer.name AS customer_name FROM ({_NESTED_SQL}) WHERE customer.segment = 'BUILDING'""")
def nested_segment_filter(spark, sf):
    n = _nested_orders(spark, sf)
    return n.where(F.col("customer.segment") == "BUILDING").select("o_orderkey", F.col("customer.name").alias("customer_name"))


@plan("customer_row_maps", "PRJ-07", sql="""
SELECT c_custkey, to_json(map(['c_custkey', 'c_name', 'c_mktsegment'],
                              [c_custkey::VARCHAR, c_name, c_mktsegment]))::VARCHAR AS row_map FROM customer""")
def customer_row_maps(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", F.to_json(R.row_as_map(c, ["c_custkey", "c_name", "c_mktsegment"])).alias("row_map"))


@plan("order_flat_map", "PRJ-08", sql="""
SELECT o_orderkey, 'price' AS kind, o_totalprice AS value FROM orders
UNION ALL SELECT o_orderkey, 'half', o_totalprice / 2 FROM orders""")
def order_flat_map(spark, sf):
    o = t(spark, sf, "orders")
    return R.flat_map(o, ["o_orderkey"], {"price": F.col("o_totalprice"), "half": F.col("o_totalprice") / 2})


@plan("customer_dropna", "FIL-04", sql="""
SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL""")
def customer_dropna(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").dropna(
        subset=["c_acctbal", "c_mktsegment"])


@plan("first_automobile_customer", "FIL-05", sql="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_mktsegment = 'AUTOMOBILE' ORDER BY c_custkey LIMIT 1""")
def first_automobile_customer(spark, sf):
    return R.find_first(t(spark, sf, "customer"), F.col("c_mktsegment") == "AUTOMOBILE", ["c_custkey"], "customer")


@plan("discount_mean_rms", "FIL-06 AGG-20", sql="""
SELECT count(l_discount) AS n, round(avg(l_discount), 6) AS mean, round(sqrt(avg(l_discount * l_discount)), 6) AS rms
FROM lineitem WHERE l_discount BETWEEN 0 AND 1""")
def discount_mean_rms(spark, sf):
    from tessera.operators.aggregate import rms_stats
    return rms_stats(t(spark, sf, "lineitem"), "l_discount", 0.0, 1.0)


@plan("orders_filter_and_negation", "FIL-10", sql="""
SELECT count(*) FILTER (WHERE o_totalprice > 200000) AS kept, count(*) FILTER (WHERE NOT (o_totalprice > 200000)) AS rejected
FROM orders""")
def orders_filter_and_negation(spark, sf):
    # The sizes of ``filter(p)`` and ``filterNot(p)`` (R.split_by) in one
    # pass: rows where p is null belong to neither side.
    p = F.col("o_totalprice") > 200000
    return t(spark, sf, "orders").agg(F.count_if(p).alias("kept"), F.count_if(~p).alias("rejected"))


# ---------------------------------------------------------------- SQL text --
# The reference parses these clause shapes; here they run through spark.sql
# with DataFrames bound as parameters (no temp views, no parser of our own).

_SQL_CASE = """
SELECT o_orderkey AS k,
       CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' END AS size,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished
FROM {orders}"""

_SQL_WHERE = """
SELECT o_orderkey, concat(o_orderpriority, '/', o_orderstatus) AS label
FROM {orders}
WHERE (o_totalprice BETWEEN 50000 AND 150000 AND o_orderpriority LIKE '1-%')
   OR (o_orderstatus IN ('O', 'P') AND NOT o_totalprice <= 400000 AND o_orderkey <> 7)
   OR o_orderpriority IS NULL"""

_SQL_ORDER = """
SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice, o_orderkey LIMIT 25"""


@plan("sql_case_projection", "SQL-01 SQL-02 SQL-03", sql=_SQL_CASE.replace("{orders}", "orders"))
def sql_case_projection(spark, sf):
    return spark.sql(_SQL_CASE, orders=t(spark, sf, "orders"))


@plan("sql_where_predicates", "SQL-04 SQL-05 SQL-06 SQL-07 SQL-08 SQL-09", sql=_SQL_WHERE.replace("{orders}", "orders"))
def sql_where_predicates(spark, sf):
    return spark.sql(_SQL_WHERE, orders=t(spark, sf, "orders"))


@plan("sql_order_limit", "SQL-10 SQL-11", sql=_SQL_ORDER.replace("{orders}", "orders"))
def sql_order_limit(spark, sf):
    return spark.sql(_SQL_ORDER, orders=t(spark, sf, "orders"))


# ------------------------------------------------------------------ joins --

# Listed parts: the price list holds parts of size <= 45; lines of other
# parts have no price and go to the error frame.
def _price_list(spark, sf):
    p = t(spark, sf, "part").where(F.col("p_size") <= 45)
    return R.first_per_key(p.select(F.col("p_partkey").alias("symbol"), F.col("p_retailprice").alias("price")),
                           "symbol", ["price"], "price")


@plan("portfolio_value", "AGG-28 JN-02", headline=True, sql="""
SELECT o_orderkey AS portfolio, round(coalesce(v.value, 0.0), 4) AS value
FROM orders LEFT JOIN (
  SELECT l_orderkey, sum(l_quantity * p_retailprice) AS value
  FROM lineitem JOIN part p ON l_partkey = p_partkey GROUP BY l_orderkey) v
ON v.l_orderkey = o_orderkey""")
def portfolio_value(spark, sf):
    pos = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("portfolio"), F.col("l_partkey").alias("symbol"),
                                         F.col("l_quantity").alias("quantity"))
    prices = t(spark, sf, "part").select(F.col("p_partkey").alias("symbol"), F.col("p_retailprice").alias("price"),
                                         F.lit(True).alias("known"))
    priced = R.lookup(pos, prices, "symbol", "left")
    # A symbol without an entry is an error, not a worthless position.
    missing = F.raise_error(F.concat(F.lit("no entry matching "), F.col("symbol").cast("string")))
    priced = priced.withColumn("price", F.when(F.col("known"), F.col("price")).otherwise(missing.cast("double")))
    value = priced.groupBy("portfolio").agg(F.sum(F.col("quantity") * F.col("price")).alias("value"))
    ports = t(spark, sf, "orders").select(F.col("o_orderkey").alias("portfolio"))
    # Empty portfolios are worth 0.0.
    return ports.join(value, "portfolio", "left").select(
        "portfolio", fround(F.coalesce("value", F.lit(0.0)), 4).alias("value"))


@plan("portfolio_missing_prices", "JN-03 ERR-04", sql="""
SELECT DISTINCT l_partkey AS symbol, 'no entry matching ' || l_partkey::VARCHAR AS error
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)""")
def portfolio_missing_prices(spark, sf):
    syms = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("symbol")).distinct()
    return R.lookup_errors(syms, _price_list(spark, sf), "symbol", "entry")


@plan("brand_segment_product", "JN-05", sql="""
WITH a AS (SELECT p_brand, count(*) AS brand_odds FROM part GROUP BY p_brand),
     b AS (SELECT c_mktsegment, count(*) AS segment_odds FROM customer GROUP BY c_mktsegment)
SELECT p_brand, c_mktsegment, brand_odds * segment_odds AS weight FROM a CROSS JOIN b""")
def brand_segment_product(spark, sf):
    a = t(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("brand_odds"))
    b = t(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("segment_odds"))
    return R.weighted_product(a, b, "brand_odds", "segment_odds").select("p_brand", "c_mktsegment", "weight")


@plan("supplier_enrichment", "JN-11 SCL-20 AGG-32", sql="""
WITH ids AS (SELECT DISTINCT l_suppkey AS s FROM lineitem)
SELECT s_suppkey, s_name, s_acctbal FROM ids JOIN supplier ON s = s_suppkey ORDER BY s_acctbal DESC, s_suppkey""")
def supplier_enrichment(spark, sf):
    # Distinct ids (one partial aggregate) -> detail -> sort.
    ids = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    s = t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return ids.join(s, "s_suppkey").orderBy(F.col("s_acctbal").desc(), "s_suppkey")


# ---------------------------------------------------------------- set ops --


@plan("labelled_documents", "SET-01", sql="""
SELECT doc_id, 1.0::DOUBLE AS label FROM labels WHERE toxic = 1
UNION ALL SELECT doc_id, 0.0::DOUBLE FROM labels WHERE toxic = 0""")
def labelled_documents(spark, sf):
    lab = t(spark, sf, "labels")
    pos = lab.where("toxic = 1").select("doc_id", F.lit(1.0).alias("label"))
    neg = lab.where("toxic = 0").select("doc_id", F.lit(0.0).alias("label"))
    return pos.unionByName(neg)


@plan("event_stream_merge", "SET-02", sql="""
SELECT event_id, event_type, ts FROM events""")
def event_stream_merge(spark, sf):
    e = t(spark, sf, "events").select("event_id", "event_type", "ts")
    named = ("purchase", "signup")
    rest = e.where(~F.coalesce(F.col("event_type").isin(*named), F.lit(False)))
    for name in named:  # one stream for each named type, and one for the others
        rest = rest.unionByName(e.where(F.col("event_type") == name))
    return rest


@plan("supplier_slot_bag_difference", "SET-03", sql="""
SELECT l_suppkey FROM lineitem EXCEPT ALL SELECT s_suppkey FROM supplier""")
def supplier_slot_bag_difference(spark, sf):
    pool = t(spark, sf, "lineitem").select("l_suppkey")
    held = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    return pool.exceptAll(held)


@plan("part_name_map_union", "SET-04", sql="""
SELECT coalesce(r.p_partkey, l.p_partkey) AS p_partkey, coalesce(r.p_name, l.p_name) AS p_name
FROM part l FULL JOIN (SELECT p_partkey, upper(p_name) AS p_name FROM part WHERE p_size > 45) r
ON l.p_partkey = r.p_partkey""")
def part_name_map_union(spark, sf):
    p = t(spark, sf, "part")
    right = p.where(F.col("p_size") > 45).select("p_partkey", F.upper("p_name").alias("p_name"))
    return R.map_union(p.select("p_partkey", "p_name"), right, "p_partkey", "p_name")


# ------------------------------------------------------------------ sorts --


@plan("customer_composite_order", "SRT-01 SRT-02", sql="""
SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS pos FROM customer""")
def customer_composite_order(spark, sf):
    c = t(spark, sf, "customer")
    order = [F.col("c_mktsegment").asc(), F.col("c_acctbal").desc(), F.col("c_custkey").asc()]
    return O.global_row_number(c, order, "pos").select("c_custkey", "pos")


@plan("top_orders", "SRT-03 SRT-06", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_orders(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.top_k(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@plan("digit_string_order", "SRT-04", sql="""
WITH s AS (SELECT (o_orderkey + 1)::VARCHAR || o_custkey::VARCHAR AS s FROM orders)
SELECT s, row_number() OVER (ORDER BY length(s), s) AS pos FROM s""")
def digit_string_order(spark, sf):
    o = t(spark, sf, "orders").select(F.concat((F.col("o_orderkey") + 1).cast("string"),
                                               F.col("o_custkey").cast("string")).alias("s"))
    return O.global_row_number(o, R.numeric_string_order("s"), "pos")


# An explicit segment ranking used as a sort order.
SEGMENT_RANKS = ["MACHINERY", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@plan("segment_rank_order", "SRT-05", sql="""
SELECT c_custkey, list_position(['MACHINERY', 'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'], c_mktsegment)::BIGINT
         AS segment_rank,
       row_number() OVER (ORDER BY coalesce(list_position(['MACHINERY', 'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'],
                                            c_mktsegment), 0), c_custkey) AS pos
FROM customer""")
def segment_rank_order(spark, sf):
    c = t(spark, sf, "customer").withColumn("segment_rank", R.rank_list_position("c_mktsegment", SEGMENT_RANKS))
    return O.global_row_number(c, ["segment_rank", "c_custkey"], "pos").select("c_custkey", "segment_rank", "pos")
