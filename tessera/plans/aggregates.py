"""Aggregation plans over the driver tables.

Stand-ins (SURVEY §7.3): ratings -> ``lineitem(l_partkey, l_quantity)``;
passenger classes -> ``orders.o_orderpriority`` / ``customer.c_mktsegment``;
"survived" -> ``o_orderstatus = 'F'``.
"""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.numeric import fround
from tessera.operators import aggregate as A
from tessera.operators.scan import fold_fragments, ordered_fold
from tessera.plans.common import t
from tessera.plans.registry import plan


@plan("rating_stats", "AGG-01", headline=True, sql="""
SELECT l_partkey, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS stddev
FROM lineitem GROUP BY l_partkey""")
def rating_stats(spark, sf):
    return A.mean_stddev(t(spark, sf, "lineitem"), "l_partkey", "l_quantity", digits=6)


@plan("rating_global_stats", "AGG-02 JN-01", sql="""
SELECT round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS stddev FROM lineitem""")
def rating_global_stats(spark, sf):
    # The reference cross-joins two one-row aggregates; one aggregate with
    # two outputs is the same row from a single scan.
    return A.mean_stddev(t(spark, sf, "lineitem"), None, "l_quantity", digits=6)


@plan("class_filtered_means", "AGG-03", sql="""
SELECT round(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END), 6) AS mean_urgent,
       round(avg(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END), 6) AS mean_high,
       round(avg(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice END), 6) AS mean_medium,
       round(avg(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice END), 6) AS mean_not_specified,
       round(avg(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END), 6) AS mean_low
FROM orders""")
def class_filtered_means(spark, sf):
    p = F.col("o_orderpriority")
    return A.conditional_means(t(spark, sf, "orders"), "o_totalprice", {
        "mean_urgent": p == "1-URGENT", "mean_high": p == "2-HIGH", "mean_medium": p == "3-MEDIUM",
        "mean_not_specified": p == "4-NOT SPECIFIED", "mean_low": p == "5-LOW"}, 6)


@plan("priority_mean_price", "AGG-04 SRT-01", sql="""
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean_price
FROM orders GROUP BY o_orderpriority ORDER BY o_orderpriority""")
def priority_mean_price(spark, sf):
    return (t(spark, sf, "orders").groupBy("o_orderpriority")
            .agg(fround(F.avg("o_totalprice"), 6).alias("mean_price")).orderBy("o_orderpriority"))


def _orders_per_customer(spark, sf, *extra_keys):
    # Pre-aggregate the large side to one row per (customer, extra keys)
    # before the join so the join shuffle carries partial sums, not orders.
    return (t(spark, sf, "orders").groupBy("o_custkey", *extra_keys)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("sum_price")))


@plan("segment_means", "AGG-05", sql="""
SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean_acctbal, round(avg(o_totalprice), 6) AS mean_price
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def segment_means(spark, sf):
    per_cust = _orders_per_customer(spark, sf)
    c = t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    j = per_cust.join(c, per_cust.o_custkey == c.c_custkey)
    return j.groupBy("c_mktsegment").agg(
        fround(F.sum(F.col("c_acctbal") * F.col("n")) / F.sum("n"), 6).alias("mean_acctbal"),
        fround(F.sum("sum_price") / F.sum("n"), 6).alias("mean_price"))


@plan("priority_finished_rate", "AGG-06", sql="""
SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 6) AS rate
FROM orders GROUP BY o_orderpriority""")
def priority_finished_rate(spark, sf):
    return t(spark, sf, "orders").groupBy("o_orderpriority").agg(
        fround(A.rate(F.col("o_orderstatus") == "F"), 6).alias("rate"))


@plan("priority_counts", "AGG-07", sql="""
SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority""")
def priority_counts(spark, sf):
    return t(spark, sf, "orders").groupBy("o_orderpriority").count()


@plan("segment_status_counts", "AGG-07", sql="""
SELECT c_mktsegment, o_orderstatus, count(*) AS count
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus""")
def segment_status_counts(spark, sf):
    per_cust = _orders_per_customer(spark, sf, "o_orderstatus")
    c = t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = per_cust.join(c, per_cust.o_custkey == c.c_custkey)
    return j.groupBy("c_mktsegment", "o_orderstatus").agg(F.sum("n").alias("count"))


@plan("finished_share_of_all", "AGG-08", sql="""
WITH g AS (SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) AS n
           FROM orders GROUP BY o_orderpriority),
     s AS (SELECT o_orderpriority, finished * 100.0 / sum(n) OVER () AS share FROM g)
SELECT o_orderpriority, round(share, 6) AS share, round(max(share) OVER (), 6) AS max_share FROM s""")
def finished_share_of_all(spark, sf):
    g = t(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count(F.lit(1)).alias("n"))
    # The window runs over the aggregated classes only (one row per class).
    everything = W.partitionBy()
    s = g.select("o_orderpriority", (F.col("finished") * 100.0 / F.sum("n").over(everything)).alias("share"))
    return s.select("o_orderpriority", fround("share", 6).alias("share"),
                    fround(F.max("share").over(everything), 6).alias("max_share"))


@plan("filtered_count", "AGG-09 FIL-01 FIL-02", sql="""
SELECT count(*) AS n FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 100000 AND 200000""")
def filtered_count(spark, sf):
    o = t(spark, sf, "orders").where("o_orderstatus = 'F'").where(F.col("o_totalprice").between(100000, 200000))
    return o.agg(F.count(F.lit(1)).alias("n"))


@plan("top_conditional_sum", "AGG-10 SRT-06", sql="""
SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'F' THEN 1 END)::BIGINT AS finished
FROM orders GROUP BY o_orderpriority ORDER BY finished DESC NULLS LAST, o_orderpriority LIMIT 1""")
def top_conditional_sum(spark, sf):
    # No ``otherwise``: a class without hits sums to null, as in the reference.
    g = t(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.lit(1))).alias("finished"))
    return g.orderBy(F.col("finished").desc_nulls_last(), "o_orderpriority").limit(1)


@plan("describe_orders", "AGG-11", sql="""
SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean,
       round(stddev_samp(o_totalprice), 6) AS stddev, min(o_totalprice) AS min_value, max(o_totalprice) AS max_value
FROM orders
UNION ALL
SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey::DOUBLE), 6), round(stddev_samp(o_custkey::DOUBLE), 6),
       min(o_custkey)::DOUBLE, max(o_custkey)::DOUBLE FROM orders
UNION ALL
SELECT 'o_orderkey', count(o_orderkey), round(avg(o_orderkey::DOUBLE), 6), round(stddev_samp(o_orderkey::DOUBLE), 6),
       min(o_orderkey)::DOUBLE, max(o_orderkey)::DOUBLE FROM orders""")
def describe_orders(spark, sf):
    return A.describe_long(t(spark, sf, "orders"), ["o_totalprice", "o_custkey", "o_orderkey"])


@plan("describe_orders_text", "AGG-11", sql="""
SELECT 'o_orderstatus' AS column_name, count(o_orderstatus) AS n, min(o_orderstatus) AS min_value, max(o_orderstatus) AS max_value
FROM orders
UNION ALL SELECT 'o_orderpriority', count(o_orderpriority), min(o_orderpriority), max(o_orderpriority) FROM orders
UNION ALL SELECT 'o_orderdate', count(o_orderdate), strftime(min(o_orderdate), '%Y-%m-%d'), strftime(max(o_orderdate), '%Y-%m-%d')
FROM orders""")
def describe_orders_text(spark, sf):
    # The columns without a mean: strings, and the date as ISO text.
    cols = {"o_orderstatus": F.col("o_orderstatus"), "o_orderpriority": F.col("o_orderpriority"),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd")}
    wide = t(spark, sf, "orders").agg(*[f(c).alias(f"{n}__{k}") for n, c in cols.items()
                                       for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))])
    parts = ", ".join(f"'{n}', `{n}__n`, `{n}__lo`, `{n}__hi`" for n in cols)
    return wide.selectExpr(f"stack({len(cols)}, {parts}) as (column_name, n, min_value, max_value)")


@plan("price_summary", "AGG-12", sql="""
SELECT count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS stddev,
       min(o_totalprice) AS min_value,
       quantile_disc(o_totalprice, 0.25) AS q25, quantile_disc(o_totalprice, 0.5) AS q50,
       quantile_disc(o_totalprice, 0.75) AS q75, max(o_totalprice) AS max_value
FROM orders""")
def price_summary(spark, sf):
    return A.quartile_summary(t(spark, sf, "orders"), "o_totalprice")


@plan("customer_null_counts", "AGG-13 PRJ-09", sql="""
SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey, count(*) FILTER (WHERE c_name IS NULL) AS c_name,
       count(*) FILTER (WHERE c_nationkey IS NULL) AS c_nationkey, count(*) FILTER (WHERE c_acctbal IS NULL) AS c_acctbal,
       count(*) FILTER (WHERE c_mktsegment IS NULL) AS c_mktsegment
FROM customer""")
def customer_null_counts(spark, sf):
    return A.null_counts(t(spark, sf, "customer"))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS corr FROM lineitem")
            parts.append(f"SELECT '{b}' AS x, '{a}' AS y, round(corr({a}, {b}), 6) AS corr FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@plan("lineitem_correlations", "AGG-14", sql=_corr_sql())
def lineitem_correlations(spark, sf):
    return A.pairwise_corr(t(spark, sf, "lineitem"), _CORR_COLS)


@plan("balance_histogram", "AGG-15", sql="""
SELECT floor(c_acctbal / 1000)::BIGINT * 1000 AS bucket, c_mktsegment, count(*) AS count
FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1, 2""")
def balance_histogram(spark, sf):
    c = t(spark, sf, "customer").where(F.col("c_acctbal").isNotNull())
    bucket = (F.floor(F.col("c_acctbal") / 1000) * 1000).cast("bigint")
    return c.groupBy(bucket.alias("bucket"), "c_mktsegment").count()


@plan("sum_of_squares", "AGG-26", sql="""
SELECT count(*) AS n, sum(o_orderkey::HUGEINT * o_orderkey)::VARCHAR AS sum_sq,
       ((2 * max(o_orderkey)::HUGEINT ** 3 + 3 * max(o_orderkey)::HUGEINT ** 2 + max(o_orderkey)) // 6)::HUGEINT::VARCHAR
         AS closed_form
FROM orders""")
def sum_of_squares(spark, sf):
    k = F.col("o_orderkey").cast("decimal(38,0)")
    g = t(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"), F.sum(k * k).alias("s"), F.max(k).alias("m"))
    m = F.col("m")
    closed = ((F.lit(2) * m * m * m + F.lit(3) * m * m + m) / 6).cast("decimal(38,0)")
    return g.select("n", F.col("s").cast("string").alias("sum_sq"), closed.cast("string").alias("closed_form"))


@plan("chunked_sum", "AGG-27", sql="""
SELECT count(*) AS n, sum(l_quantity) AS total FROM lineitem""")
def chunked_sum(spark, sf):
    # Partial sums per input split, then one final sum: the reference's ten
    # chunked futures are exactly Spark's partial/final aggregation.
    return t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"))


@plan("order_uncertain_totals", "AGG-29", sql="""
SELECT l_orderkey, round(sum(l_extendedprice), 4) AS mu,
       round(sqrt(sum((l_extendedprice * l_discount) * (l_extendedprice * l_discount))), 4) AS sigma,
       round(sum(l_extendedprice * l_tax), 4) AS delta
FROM lineitem GROUP BY l_orderkey""")
def order_uncertain_totals(spark, sf):
    li = t(spark, sf, "lineitem").select(
        "l_orderkey", "l_extendedprice",
        (F.col("l_extendedprice") * F.col("l_discount")).alias("sd"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("bound"))
    return A.sum_with_uncertainty(li, ["l_orderkey"], "l_extendedprice", sigma="sd", delta="bound", digits=4)


@plan("last_event_per_user", "AGG-31", sql="""
SELECT user_id, event_type, value, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def last_event_per_user(spark, sf):
    return A.last_wins(t(spark, sf, "events"), "user_id", ["ts", "event_id"], ["event_type", "value", "event_id"])


@plan("distinct_user_event_types", "AGG-32", sql="""
SELECT DISTINCT user_id, event_type FROM events""")
def distinct_user_event_types(spark, sf):
    return t(spark, sf, "events").select("user_id", "event_type").dropDuplicates()


@plan("conversation_monoids", "AGG-33", sql="""
SELECT conv_id, string_agg(substr(role, 1, 1), '' ORDER BY turn) AS roles, coalesce(sum(turn), 0)::BIGINT AS turn_sum
FROM conversations GROUP BY conv_id""")
def conversation_monoids(spark, sf):
    # Concatenation ("" is its identity) needs the turn order, addition does not.
    c = t(spark, sf, "conversations").select("conv_id", "turn", F.substring("role", 1, 1).alias("r"))
    roles = ordered_fold(c, "conv_id", ["turn"], F.coalesce("r", F.lit("")), F.lit(""), lambda a, b: F.concat(a, b), "roles")
    sums = c.groupBy(F.col("conv_id").alias("_c")).agg(F.coalesce(F.sum("turn"), F.lit(0)).cast("bigint").alias("turn_sum"))
    return roles.join(sums, F.col("conv_id").eqNullSafe(F.col("_c"))).select("conv_id", "roles", "turn_sum")


@plan("conversation_role_fragments", "AGG-33", sql="""
SELECT conv_id, string_agg(substr(role, 1, 1), '' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id""")
def conversation_role_fragments(spark, sf):
    # Fragments of the concatenations, joined here only so that they can be compared.
    c = t(spark, sf, "conversations").select("conv_id", "turn", F.substring("role", 1, 1).alias("r"))
    parts = fold_fragments(c, "conv_id", ["turn"], F.coalesce("r", F.lit("")), F.lit(""), lambda a, b: F.concat(a, b))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "fragment"))), lambda x: x["fragment"]), "")
    return parts.groupBy("conv_id").agg(joined.alias("roles"))


@plan("supplier_revenue_mapreduce", "AGG-21 UDF-01", sql="""
SELECT l_suppkey AS supplier, round(sum(l_extendedprice * (1 - l_discount)), 4) AS result
FROM lineitem GROUP BY l_suppkey""")
def supplier_revenue_mapreduce(spark, sf):
    li = t(spark, sf, "lineitem")
    out = A.map_reduce(li, {"supplier": F.col("l_suppkey"),
                            "revenue": F.col("l_extendedprice") * (1 - F.col("l_discount"))},
                       key="supplier", reducer=F.sum)
    return out.select("supplier", fround("result", 4).alias("result"))


@plan("supplier_big_line_fold", "AGG-22", sql="""
SELECT s_suppkey AS supplier, coalesce(v.result, 0)::BIGINT AS result
FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) FILTER (WHERE l_quantity > 25) AS result
                         FROM lineitem GROUP BY l_suppkey) v ON v.l_suppkey = s_suppkey""")
def supplier_big_line_fold(spark, sf):
    # Fold with a zero and a different result type: quantities (double) fold
    # into a count (long); suppliers without lines get the zero.
    li = t(spark, sf, "lineitem")
    folded = A.map_reduce(li, {"supplier": F.col("l_suppkey"),
                               "big": F.when(F.col("l_quantity") > 25, 1).otherwise(0)},
                          key="supplier", reducer=lambda c: F.sum(c).cast("bigint"))
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier"))
    return s.join(folded, "supplier", "left").select(
        "supplier", F.coalesce("result", F.lit(0)).cast("bigint").alias("result"))


@plan("order_part_lists", "AGG-23", sql="""
SELECT l_orderkey, to_json(list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity))::VARCHAR AS parts
FROM lineitem GROUP BY l_orderkey""")
def order_part_lists(spark, sf):
    # Lines of one order form a small, bounded list; order it by line number
    # (ties broken by the other columns, as (order, line) is not unique here).
    li = t(spark, sf, "lineitem")
    s = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")))
    parts = F.transform(s, lambda x: x["l_partkey"])
    # The list is returned as JSON text so both engines compare it the same way.
    return li.groupBy("l_orderkey").agg(F.to_json(parts).alias("parts"))
