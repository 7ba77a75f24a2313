"""Streaming and stateful plans.

Trades: ``events`` with ``purchase`` = buy of ``ceil(value)`` and ``error``
= sell of ``ceil(value)``, keyed by ``user_id``, ordered by ``(ts, event_id)``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.policies import with_context
from tessera.plans.common import t
from tessera.plans.registry import plan
from tessera.session import checkpoint_dir
from tessera.streaming import chains as C
from tessera.streaming import portfolio as P
from tessera.streaming import state as S


def _trades(df):
    d = (F.when(F.col("event_type") == "purchase", F.ceil("value"))
         .otherwise(-F.ceil("value")).cast("double"))
    return df.where(F.col("event_type").isin("purchase", "error")).select("user_id", "ts", "event_id", d.alias("delta"))


_PORTFOLIO_SQL = """
WITH RECURSIVE tr AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         (CASE WHEN event_type = 'purchase' THEN ceil(value) ELSE -ceil(value) END)::DOUBLE AS d
  FROM events WHERE event_type IN ('purchase', 'error')),
f(user_id, rn, owned) AS (
  SELECT user_id, rn, CASE WHEN d >= 0 THEN d END FROM tr WHERE rn = 1
  UNION ALL
  SELECT f.user_id, t.rn, CASE WHEN t.d >= 0 THEN coalesce(f.owned, 0) + t.d WHEN f.owned IS NULL THEN NULL
                               WHEN -t.d <= f.owned THEN f.owned + t.d ELSE f.owned END
  FROM f JOIN tr t ON t.user_id = f.user_id AND t.rn = f.rn + 1)
SELECT user_id, owned, rn AS trades FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) AS r FROM f) WHERE r = 1 AND owned IS NOT NULL"""


@plan("user_portfolio_fold", "STR-06", sql=_PORTFOLIO_SQL)
def user_portfolio_fold(spark, sf):
    # Hot users are cut across partitions with exact stretch summaries.
    return S.portfolio_fold(_trades(t(spark, sf, "events")), "user_id", ["ts", "event_id"], "delta", split=True)


@plan("hot_user_portfolio_fold", "STR-06", sql=_PORTFOLIO_SQL.replace(
    "FROM events WHERE event_type IN ('purchase', 'error')),",
    "FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)\n"
    "  WHERE event_type IN ('purchase', 'error')),"))
def hot_user_portfolio_fold(spark, sf):
    # Every third event is reassigned to user 0 (a third of all rows, none
    # dropped); the split path is forced so the hot-key fold is always checked.
    e = t(spark, sf, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id")))
    return S.portfolio_fold(_trades(e), "user_id", ["ts", "event_id"], "delta", split=True)


#: Rows of a landed file.
FILE_ROWS = 1_000_000


def _stream_fold(spark, events):
    """The fold as a Structured Streaming query on the state store.  The events
    are landed by week, in files of a bounded number of rows; the query is
    stopped and started again on its checkpoint half way; it waits seven days
    for rows that come late."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/portfolio-{uuid.uuid4().hex}"
    trades = _trades(events).withColumn("week", F.date_trunc("week", "ts").cast("date"))
    schema = trades.drop("week").schema
    # One value for each calendar week, null ones first.
    weeks = trades.groupBy("week").count().orderBy(F.col("week").asc_nulls_first()).collect()
    half = len(weeks) // 2
    for k, (week, n) in enumerate(weeks):
        files = -(-n // FILE_ROWS)
        # A range of the time column, so that the scan skips the other weeks.
        start = F.lit(week).cast("timestamp")
        here = F.col("ts").isNull() if week is None else (F.col("ts") >= start) & (F.col("ts") < start + F.expr("interval 7 days"))
        (trades.where(here).drop("week").repartition(files, F.xxhash64("event_id"))
         .write.mode("append").parquet(f"{base}/landing"))
        if k in (half, len(weeks) - 1):
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{base}/landing")
            P.start(stream, f"{base}/checkpoint", f"{base}/late", "user_id", ["ts", "event_id"], "delta",
                    "7 days").awaitTermination()
    return P.holdings(spark, f"{base}/checkpoint", "user_id")


@plan("user_portfolio_stream", "STR-06", sql=_PORTFOLIO_SQL)
def user_portfolio_stream(spark, sf):
    return _stream_fold(spark, t(spark, sf, "events"))


@plan("hot_user_portfolio_stream", "STR-06", sql=_PORTFOLIO_SQL.replace(
    "FROM events WHERE event_type IN ('purchase', 'error')),", """FROM (SELECT * REPLACE (
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
    date_trunc('second', ts) + to_days((31 * (event_id % 3))::INT) AS ts) FROM events)
  WHERE event_type IN ('purchase', 'error')),"""))
def hot_user_portfolio_stream(spark, sf):
    # A third of all events belongs to one user, times are whole seconds (so
    # many are equal), and the events span three months.
    e = t(spark, sf, "events")
    moved = F.date_trunc("second", "ts") + F.make_dt_interval(days=(31 * (F.col("event_id") % 3)).cast("int"))
    e = e.withColumn("ts", moved.cast(e.schema["ts"].dataType)).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id")))
    return _stream_fold(spark, e)


@plan("conversation_chain_positions", "STR-01", sql="""
SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS pos FROM conversations""")
def conversation_chain_positions(spark, sf):
    return _conversation_chains(t(spark, sf, "conversations").select("conv_id", "turn"))


def _conversation_chains(c):
    # Each turn names the next one (turn + 1 of the same conversation); the
    # chain order is recovered by pointer jumping, all conversations at once.
    ident = lambda a, b: F.concat_ws(":", F.col(a).cast("string"), F.col(b).cast("string"))
    nodes = c.select(ident("conv_id", "turn").alias("id"), F.concat_ws(
        ":", F.col("conv_id").cast("string"), (F.col("turn") + 1).cast("string")).alias("next"))
    ranked = C.chain_positions(nodes)
    return c.withColumn("id", ident("conv_id", "turn")).join(ranked.select("id", "pos"), "id").drop("id")


@plan("merged_chain_payloads", "STR-02 UDF-03", sql="""
SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS pos,
       (length(text) - length(replace(text, ' ', '')))::BIGINT AS spaces FROM conversations""")
def merged_chain_payloads(spark, sf):
    # Two sources of chains, merged, with a caller's function on each payload.
    c = t(spark, sf, "conversations").select("conv_id", "turn", "text")
    sources = [_conversation_chains(c.where(F.col("conv_id") % 2 == k)) for k in (0, 1)]
    return C.merge_chains(sources, "text", lambda text: text.count(" "), "bigint", "spaces").drop("text")


@plan("conversation_payload_stats", "STR-03", sql="""
SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\\t\\n\\x0B\\f\\r ]+'))::BIGINT AS n_words,
       length(coalesce(text, ''))::BIGINT AS n_chars FROM conversations""")
def conversation_payload_stats(spark, sf):
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.regexp_extract_all(text, F.lit(r"[^\t\n\x0B\f\r ]+"), F.lit(0)))
    return t(spark, sf, "conversations").select("conv_id", "turn", words.cast("bigint").alias("n_words"),
                                                F.length(text).cast("bigint").alias("n_chars"))


def _statuses(spark, sf):
    p = t(spark, sf, "pages")
    title = F.nullif(F.regexp_extract("html", r"<title>([^<]*)</title>", 1), F.lit(""))
    code = F.when(F.col("html").contains("</html>"), 200).otherwise(206)
    cause = with_context(F.when(title.isNull(), F.lit("no title")), "page_id")
    return p.select("page_id", code.alias("code"), title.isNotNull().alias("ok"), title.alias("attribute"),
                    cause.alias("cause"))


_STATUS_SQL = """SELECT page_id, CASE WHEN contains(html, '</html>') THEN 200 ELSE 206 END AS code,
       nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') IS NOT NULL AS ok,
       nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS attribute,
       CASE WHEN nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') IS NULL
            THEN '[page_id=' || page_id::VARCHAR || '] no title' END AS cause FROM pages"""


@plan("page_fetch_statuses", "STR-04 STR-05", sql=_STATUS_SQL)
def page_fetch_statuses(spark, sf):
    return _statuses(spark, sf)


@plan("page_status_counts", "STR-04", sql=f"SELECT ok, count(*) AS n FROM ({_STATUS_SQL}) GROUP BY ok")
def page_status_counts(spark, sf):
    return _statuses(spark, sf).groupBy("ok").agg(F.count(F.lit(1)).alias("n"))


@plan("seat_holds", "STR-07", sql="""
SELECT o_custkey AS seat, o_orderkey FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
WHERE r = 1""")
def seat_holds(spark, sf):
    # Seats = customers; requests = orders naming a seat; the earliest wins.
    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("seat"), "o_orderdate", "o_orderkey")
    return S.earliest_claims(o, "seat", ["o_orderdate", "o_orderkey"], "o_orderkey")


@plan("seat_pool_remaining", "STR-07 SET-03", sql="""
SELECT c_custkey AS seat FROM customer EXCEPT ALL SELECT DISTINCT o_custkey FROM orders""")
def seat_pool_remaining(spark, sf):
    pool = t(spark, sf, "customer").select(F.col("c_custkey").alias("seat"))
    holds = seat_holds(spark, sf)
    return S.remaining_pool(pool, holds, "seat")


def _weekly(spark, rows):
    """(folder, rows) of each week of the events, in order.  The caller lands
    the rows and runs its query to the end, so a week is one batch."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/weekly-{uuid.uuid4().hex}"
    week = F.date_trunc("week", "ts")
    for w, n in rows.groupBy(week.alias("w")).count().orderBy(F.col("w").asc_nulls_first()).collect():
        yield base, rows.where(week.eqNullSafe(F.lit(w))).repartition(-(-n // FILE_ROWS), F.xxhash64("event_id"))


@plan("event_balance_cache", "STR-08", sql="""
WITH RECURSIVE wk AS (SELECT date_trunc('week', ts) AS w, max(ts) AS now FROM events GROUP BY 1),
uw AS (SELECT user_id, now, row_number() OVER (PARTITION BY user_id ORDER BY now) AS rn
       FROM (SELECT DISTINCT user_id, now FROM events JOIN wk ON wk.w = date_trunc('week', ts))),
f(user_id, rn, now, fill) AS (
  SELECT user_id, rn, now, now FROM uw WHERE rn = 1
  UNION ALL
  SELECT u.user_id, u.rn, u.now, CASE WHEN f.fill >= u.now - INTERVAL 10 DAY THEN f.fill ELSE u.now END
  FROM f JOIN uw u ON u.user_id = f.user_id AND u.rn = f.rn + 1)
SELECT user_id, c_acctbal AS balance, strftime(now, '%Y-%m-%d %H:%M:%S') AS looked_up_at,
       CASE WHEN c_acctbal IS NULL THEN 'missing' WHEN fill = now THEN 'fulfilled' ELSE 'cache' END AS source
FROM f LEFT JOIN customer ON c_custkey = user_id""")
def event_balance_cache(spark, sf):
    # Users' balances are looked up through a cache in which entries live ten
    # days of event time; each week is one batch of the stream.
    from tessera.streaming.cache import ExpiringCache

    e = t(spark, sf, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    balances = t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance"))
    for base, rows in _weekly(spark, e):
        rows.write.mode("append").parquet(f"{base}/landing")
        cache = ExpiringCache(spark, base, "user_id", "balance", "ts", 10 * 86400, lambda m: m.join(balances, "user_id"))
        (spark.readStream.schema(e.schema).parquet(f"{base}/landing").writeStream.foreachBatch(cache.step)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return cache.lookups().select("user_id", "balance", "source", F.date_format(
        "looked_up_at", "yyyy-MM-dd HH:mm:ss").alias("looked_up_at"))


_SOURCES = ("purchase", "error", None)  # None: all other events


@plan("event_streams_merged", "SET-02 STR-02", sql="""
SELECT event_id, CASE WHEN event_type IN ('purchase', 'error') THEN event_type ELSE 'other' END AS source,
       (dense_rank() OVER (ORDER BY date_trunc('week', ts)) - 1)::BIGINT AS arrival FROM events""")
def event_streams_merged(spark, sf):
    # Three landed sources read by one query; a week lands in all of them
    # before the query goes on.
    from tessera.streaming import merge as MG

    e = t(spark, sf, "events").select("event_id", "event_type", "ts")
    kind = F.when(F.col("event_type").isin("purchase", "error"), F.col("event_type")).otherwise("other")
    for base, rows in _weekly(spark, e):
        names = [s or "other" for s in _SOURCES]
        for s in names:
            rows.where(kind == s).write.mode("append").parquet(f"{base}/landing/{s}")
        streams = {s: spark.readStream.schema(e.schema).parquet(f"{base}/landing/{s}") for s in names}
        MG.start_merge(streams, f"{base}/merged", f"{base}/checkpoint").awaitTermination()
    return MG.merged(spark, f"{base}/merged").select("event_id", "source", "arrival")


def _anchors(html: str | None) -> int:
    return (html or "").count("<a ")


@plan("page_anchors_in_time", "STR-09", sql="""
SELECT page_id, 'done' AS status, ((length(coalesce(html, '')) - length(replace(coalesce(html, ''), '<a ', ''))) // 3)::BIGINT
       AS value, NULL::VARCHAR AS error FROM pages""")
def page_anchors_in_time(spark, sf):
    # Far less work than the limit allows, so every call ends in time.
    from tessera.operators.deadline import call_within

    return call_within(t(spark, sf, "pages").select("page_id", "html"), "html", _anchors, "bigint", seconds=300)


@plan("event_timeout_split", "STR-09", sql="""
SELECT event_id, CASE WHEN value * 10 > 1000 THEN 'timed out' ELSE 'done' END AS status FROM events""")
def event_timeout_split(spark, sf):
    # value x 10 stands for the item's elapsed milliseconds; 1000 ms limit.
    e = t(spark, sf, "events")
    return e.select("event_id", F.when(F.col("value") * 10 > 1000, "timed out").otherwise("done").alias("status"))


@plan("price_read_through", "STR-08", sql="""
SELECT DISTINCT l_partkey AS symbol, p_retailprice AS price, CASE WHEN p_size <= 45 THEN 'cache' ELSE 'fulfilled' END AS source
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def price_read_through(spark, sf):
    from tessera.streaming.cache import read_through
    part = t(spark, sf, "part")
    keys = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("symbol"))
    cache = part.where(F.col("p_size") <= 45).select(F.col("p_partkey").alias("symbol"), F.col("p_retailprice").alias("price"))
    source = part.select(F.col("p_partkey").alias("symbol"), F.col("p_retailprice").alias("price"))
    return read_through(keys, "symbol", cache, "price", lambda missing: missing.join(source, "symbol"))
