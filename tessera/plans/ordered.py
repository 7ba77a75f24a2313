"""Order-dependent plans.

Sequences: ``events.event_type`` / ``value`` per ``user_id`` ordered by
``(ts, event_id)``; meeting intervals: ``orders`` from ``o_orderdate`` for
``1 + o_orderkey % 30`` days per customer; whole-table positions: ``orders``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import fround
from tessera.operators import generate
from tessera.operators import ordered as O
from tessera.plans.common import t
from tessera.plans.registry import plan

EV_ORDER = ["ts", "event_id"]


def _intervals(spark, sf):
    o = t(spark, sf, "orders")
    s = F.to_date("o_orderdate")
    return o.select("o_custkey", "o_orderkey", s.alias("s"),
                    F.date_add(s, (1 + F.col("o_orderkey") % 30).cast("int")).alias("e"))


_IV_SQL = """iv AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS s,
                  o_orderdate::DATE + (1 + o_orderkey % 30)::INTEGER AS e FROM orders),
ev AS (SELECT o_custkey, o_orderkey, s AS t, 1 AS kind, 1 AS delta FROM iv
       UNION ALL SELECT o_custkey, o_orderkey, e, 0, -1 FROM iv)"""


@plan("customer_max_concurrency", "WIN-01 SCL-11", sql=f"""
WITH {_IV_SQL},
occ AS (SELECT o_custkey, sum(delta) OVER (PARTITION BY o_custkey ORDER BY t, kind, o_orderkey
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS o FROM ev)
SELECT c_custkey AS o_custkey, coalesce(max(o), 0)::BIGINT AS rooms
FROM customer LEFT JOIN occ ON occ.o_custkey = c_custkey GROUP BY c_custkey""")
def customer_max_concurrency(spark, sf):
    rooms = O.max_concurrency(_intervals(spark, sf), "o_custkey", "s", "e")
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    # Customers without intervals have zero rooms (empty input -> 0).
    return c.join(rooms, "o_custkey", "left").select(
        "o_custkey", F.coalesce("rooms", F.lit(0)).cast("bigint").alias("rooms"))


@plan("customer_occupancy_series", "WIN-02", sql=f"""
WITH {_IV_SQL}
SELECT o_custkey, o_orderkey, t, kind,
       row_number() OVER (PARTITION BY o_custkey ORDER BY t, kind, o_orderkey) AS step,
       sum(delta) OVER (PARTITION BY o_custkey ORDER BY t, kind, o_orderkey
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS occupancy
FROM ev""")
def customer_occupancy_series(spark, sf):
    s = O.occupancy_series(_intervals(spark, sf), "o_custkey", "s", "e", tie=["o_orderkey"])
    return s.select("o_custkey", "o_orderkey", "t", "kind", "step", F.col("occupancy").cast("bigint"))


@plan("user_running_value", "WIN-03", sql="""
SELECT user_id, event_id, row_number() OVER w AS idx, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 4) AS running
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def user_running_value(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    e = O.key_scan(e, "user_id", EV_ORDER, sum_col="value")  # one pass: position and running sum
    return e.select("user_id", "event_id", "idx", fround("running", 4).alias("running"))


_RUN_SQL = """r AS (SELECT user_id, event_id, event_type,
        sum(CASE WHEN prev IS NULL OR prev <> event_type THEN 1 ELSE 0 END)
          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_no
      FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))"""


@plan("user_event_compress", "WIN-04", sql="""
SELECT user_id, event_id, event_type FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE prev IS NULL OR prev <> event_type""")
def user_event_compress(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return O.compress(e, "user_id", EV_ORDER, "event_type").select("user_id", "event_id", "event_type")


@plan("user_event_pack", "WIN-05", sql=f"""
WITH {_RUN_SQL}
SELECT user_id, run_no::BIGINT AS run_no, count(*) AS n, min(event_type) AS event_type,
       to_json(list(event_type))::VARCHAR AS pack
FROM r GROUP BY user_id, run_no""")
def user_event_pack(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    # Packs are returned as JSON text so both engines compare lists the same way.
    return O.pack(e, "user_id", EV_ORDER, "event_type").withColumn("pack", F.to_json("pack")).drop("part")


@plan("user_event_rle", "WIN-06", sql=f"""
WITH {_RUN_SQL}
SELECT user_id, run_no::BIGINT AS run_no, count(*) AS n, min(event_type) AS event_type FROM r GROUP BY user_id, run_no""")
def user_event_rle(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return O.run_length_encode(e, "user_id", EV_ORDER, "event_type")


@plan("hot_user_event_rle", "WIN-06", sql=f"""
WITH e AS (SELECT event_id, ts, event_type, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id FROM events),
r AS (SELECT user_id, event_id, event_type,
        sum(CASE WHEN prev IS NULL OR prev <> event_type THEN 1 ELSE 0 END)
          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_no
      FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM e))
SELECT user_id, run_no::BIGINT AS run_no, count(*) AS n, min(event_type) AS event_type FROM r GROUP BY user_id, run_no""")
def hot_user_event_rle(spark, sf):
    # Every third event is reassigned to user 0, which then holds a third of
    # all rows (nothing is dropped).  The segmented scan is forced, so this
    # query always exercises the skew path: the hot user's run numbering is
    # split across partitions and stitched by carries.
    e = t(spark, sf, "events").select(
        "event_id", "ts", "event_type",
        F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"))
    return O.run_length_encode(e, "user_id", EV_ORDER, "event_type")


@plan("user_event_rle_modified", "WIN-07", sql=f"""
WITH {_RUN_SQL}
SELECT user_id, run_no::BIGINT AS run_no, CASE WHEN count(*) > 1 THEN count(*) END AS n, min(event_type) AS event_type
FROM r GROUP BY user_id, run_no""")
def user_event_rle_modified(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return O.run_length_encode(e, "user_id", EV_ORDER, "event_type", modified=True)


@plan("user_event_rle_decode", "WIN-08", sql=f"""
WITH {_RUN_SQL}
SELECT user_id, run_no::BIGINT AS run_no, event_type, (row_number() OVER (PARTITION BY user_id, run_no ORDER BY event_id) - 1)::INTEGER AS copy
FROM r""")
def user_event_rle_decode(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    enc = O.run_length_encode(e, "user_id", EV_ORDER, "event_type")
    return O.replicate(enc, "n").select("user_id", "run_no", "event_type", F.col("copy").cast("int"))


@plan("event_duplicate_n", "WIN-08", sql="""
SELECT event_id, c.copy::INTEGER AS copy
FROM events, LATERAL (SELECT unnest(range(greatest(floor(value)::BIGINT % 3, 0))) AS copy) c""")
def event_duplicate_n(spark, sf):
    # n = whole part of value modulo 3: 0 copies drop the row.
    e = t(spark, sf, "events").select("event_id", "value")
    n = F.floor("value") % 3
    return O.replicate(e, n).select("event_id", F.col("copy").cast("int"))


@plan("user_last_penultimate_kth", "WIN-09", sql="""
SELECT user_id,
       max(CASE WHEN d = 1 THEN event_type END) AS last,
       max(CASE WHEN d = 2 THEN event_type END) AS penultimate,
       max(CASE WHEN a = 3 THEN event_type END) AS kth
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a,
                row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS d FROM events)
GROUP BY user_id""")
def user_last_penultimate_kth(spark, sf):
    return O.nth_from_start_and_end(t(spark, sf, "events"), "user_id", EV_ORDER, "event_type", k=3)


@plan("conversation_role_palindrome", "WIN-10", sql="""
SELECT conv_id, count(*)::BIGINT AS n, list(role ORDER BY turn) = list(role ORDER BY turn DESC) AS is_palindrome
FROM conversations GROUP BY conv_id""")
def conversation_role_palindrome(spark, sf):
    return O.is_palindrome(t(spark, sf, "conversations"), "conv_id", ["turn"], "role")


@plan("user_values_sorted", "WIN-11", sql="""
SELECT user_id, bool_and(coalesce(prev <= value, true)) AS is_sorted
FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
GROUP BY user_id""")
def user_values_sorted(spark, sf):
    return O.is_sorted(t(spark, sf, "events"), "user_id", EV_ORDER, "value")


@plan("user_even_position_sum", "WIN-12 FIL-07", sql="""
SELECT user_id, round(sum(CASE WHEN (rn - 1) % 2 = 0 THEN value END), 4) AS even_sum
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY user_id""")
def user_even_position_sum(spark, sf):
    return O.even_position_sum(t(spark, sf, "events"), "user_id", EV_ORDER, "value")


@plan("order_price_positions", "SRT-02 FIL-07", sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos,
       ((row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) % 2 = 0) AS even_position
FROM orders""")
def order_price_positions(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    p = O.global_row_number(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], "pos")
    return p.select("o_orderkey", "pos", ((F.col("pos") - 1) % 2 == 0).alias("even_position"))


@plan("orders_take_drop", "SRT-07 SQL-10 SQL-11", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def orders_take_drop(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(100).limit(50)


@plan("balance_rank_zip", "JN-07", sql="""
WITH a AS (SELECT c_acctbal AS v, row_number() OVER (ORDER BY c_acctbal) AS r FROM customer WHERE c_acctbal IS NOT NULL),
     b AS (SELECT s_acctbal AS v, row_number() OVER (ORDER BY s_acctbal) AS r FROM supplier WHERE s_acctbal IS NOT NULL)
SELECT count(*) AS pairs, round(sum(abs(a.v - b.v)), 4) AS cost FROM a JOIN b USING (r)""")
def balance_rank_zip(spark, sf):
    z = O.rank_zip(t(spark, sf, "customer"), t(spark, sf, "supplier"), "c_acctbal", "s_acctbal")
    return z.agg(F.count(F.lit(1)).alias("pairs"), fround(F.sum(F.abs(F.col("a") - F.col("b"))), 4).alias("cost"))


@plan("customer_supplier_zip", "JN-08", sql="""
WITH a AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS pos FROM customer),
     b AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS pos FROM supplier)
SELECT pos, c_name, s_name FROM a JOIN b USING (pos)""")
def customer_supplier_zip(spark, sf):
    z = O.positional_zip(t(spark, sf, "customer").select("c_custkey", "c_name"), ["c_custkey"],
                         t(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"])
    return z.select("pos", "c_name", "s_name")


@plan("customer_supplier_interleave", "JN-08 SET-02", sql="""
WITH a AS (SELECT c_name AS name, row_number() OVER (ORDER BY c_custkey) AS pos FROM customer),
     b AS (SELECT s_name AS name, row_number() OVER (ORDER BY s_suppkey) AS pos FROM supplier),
     m AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM customer UNION ALL SELECT count(*) FROM supplier))
SELECT 2 * pos - 1 AS slot, name FROM a WHERE pos <= (SELECT n FROM m)
UNION ALL SELECT 2 * pos AS slot, name FROM b WHERE pos <= (SELECT n FROM m)""")
def customer_supplier_interleave(spark, sf):
    z = O.positional_zip(t(spark, sf, "customer").select("c_custkey", "c_name"), ["c_custkey"],
                         t(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"])
    left = z.select((2 * F.col("pos") - 1).alias("slot"), F.col("c_name").alias("name"))
    right = z.select((2 * F.col("pos")).alias("slot"), F.col("s_name").alias("name"))
    return left.unionByName(right)


def _brand_wheel(spark, sf):
    """Odds per brand and the cumulative interval [lo, hi) each owns.  The
    window runs over the aggregated brands (one row per category)."""
    from pyspark.sql import Window as W
    odds = t(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("odds"))
    w = W.orderBy("p_brand").rowsBetween(W.unboundedPreceding, W.currentRow)
    return odds.withColumn("hi", F.sum("odds").over(w)).withColumn("lo", F.col("hi") - F.col("odds"))


_WHEEL_SQL = """odds AS (SELECT p_brand, count(*) AS odds FROM part GROUP BY p_brand),
wheel AS (SELECT p_brand, odds, sum(odds) OVER (ORDER BY p_brand ROWS UNBOUNDED PRECEDING) - odds AS lo,
                 sum(odds) OVER (ORDER BY p_brand ROWS UNBOUNDED PRECEDING) AS hi FROM odds),
total AS (SELECT sum(odds) AS total FROM odds),
draws AS (SELECT floor(('0x' || substr(md5('7:' || l_orderkey::VARCHAR || ':' || l_linenumber::VARCHAR), 1, 13))::BIGINT
                       / 4503599627370496.0 * (SELECT total FROM total))::BIGINT AS draw FROM lineitem)"""


@plan("brand_wheel_lookup", "JN-09 GEN-03", sql=f"""
WITH {_WHEEL_SQL}
SELECT w.p_brand, count(*) AS draws FROM draws d JOIN wheel w ON d.draw >= w.lo AND d.draw < w.hi GROUP BY w.p_brand""")
def brand_wheel_lookup(spark, sf):
    wheel = _brand_wheel(spark, sf)
    total = wheel.agg(F.sum("odds")).scalar()  # scalar subquery, no join
    li = t(spark, sf, "lineitem")
    draws = li.select(generate.spin(7, total, "l_orderkey", "l_linenumber").alias("draw"))
    hit = O.range_lookup(draws, "draw", wheel.select("p_brand", "lo", "hi"), "lo", "hi")
    return hit.groupBy("p_brand").agg(F.count(F.lit(1)).alias("draws"))


@plan("brand_wheel_frequencies", "AGG-34 JN-09", sql=f"""
WITH {_WHEEL_SQL},
hits AS (SELECT w.p_brand, count(*) AS draws FROM draws d JOIN wheel w ON d.draw >= w.lo AND d.draw < w.hi GROUP BY w.p_brand)
SELECT w.p_brand, round(w.odds * 1.0 / sum(w.odds) OVER (), 6) AS expected,
       round(coalesce(h.draws, 0) * 1.0 / sum(coalesce(h.draws, 0)) OVER (), 6) AS observed
FROM wheel w LEFT JOIN hits h USING (p_brand)""")
def brand_wheel_frequencies(spark, sf):
    from pyspark.sql import Window as W
    hits = brand_wheel_lookup(spark, sf)
    wheel = _brand_wheel(spark, sf)
    everything = W.partitionBy()
    j = wheel.join(hits, "p_brand", "left").withColumn("draws", F.coalesce("draws", F.lit(0)))
    return j.select("p_brand", fround(F.col("odds") / F.sum("odds").over(everything), 6).alias("expected"),
                    fround(F.col("draws") / F.sum("draws").over(everything), 6).alias("observed"))


@plan("part_size_three_sum", "JN-06", sql="""
WITH v AS (SELECT p_size AS x, count(*) AS c FROM part GROUP BY p_size)
SELECT a.x AS x, b.x AS y, c.x AS z,
       (CASE WHEN a.x = b.x AND b.x = c.x THEN a.c * (a.c - 1) * (a.c - 2) // 6
             WHEN a.x = b.x THEN a.c * (a.c - 1) // 2 * c.c
             WHEN b.x = c.x THEN a.c * (b.c * (b.c - 1) // 2)
             ELSE a.c * b.c * c.c END)::BIGINT AS n_triples
FROM v a JOIN v b ON a.x <= b.x JOIN v c ON c.x = 60 - a.x - b.x AND c.x >= b.x
WHERE (CASE WHEN a.x = b.x AND b.x = c.x THEN a.c * (a.c - 1) * (a.c - 2) // 6
             WHEN a.x = b.x THEN a.c * (a.c - 1) // 2 * c.c
             WHEN b.x = c.x THEN a.c * (b.c * (b.c - 1) // 2)
             ELSE a.c * b.c * c.c END) > 0""")
def part_size_three_sum(spark, sf):
    return O.three_sum_values(t(spark, sf, "part"), "p_size", target=60)


# The two periodic rules of the classic FizzBuzz exercise.
FIZZ_BUZZ_RULES = [("Fizz", 0, 3), ("Buzz", 0, 5)]


@plan("order_key_periodic_rules", "JN-10 FIL-08", sql="""
SELECT o_orderkey, to_json(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'Fizz' END,
                                        CASE WHEN o_orderkey % 5 = 0 THEN 'Buzz' END], lambda x: x IS NOT NULL))::VARCHAR AS labels
FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0""")
def order_key_periodic_rules(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey")
    return O.periodic_labels(o, "o_orderkey", FIZZ_BUZZ_RULES).withColumn("labels", F.to_json("labels"))
