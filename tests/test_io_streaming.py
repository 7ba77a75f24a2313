import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.sources import files as IO
from tessera.sources import sinks as K
from tessera.streaming import chains as C
from tessera.streaming import state as S


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_csv_quotes_header_and_corrupt_rows(spark, tmp):
    p = write(os.path.join(tmp, "days.csv"), 'Name,Index\n"Sunday",1\n"Monday",2\n"TGIF, Yay",3\nbroken,"x"\n')
    df = IO.read_csv(spark, p, "Name string, Index int, _bad string", corrupt_column="_bad")
    got = [(r.Name, r.Index, r._bad) for r in df.collect()]
    assert got[2] == ("TGIF, Yay", 3, None) and got[3][1] is None and got[3][2] == 'broken,"x"'
    keep = IO.read_csv_lines(spark, p).first().fields
    assert keep == ["Name", "Index"]


def test_tab_separated_utf16(spark, tmp):
    p = write(os.path.join(tmp, "r.tsv"), "Name\tNotes\nRobin\t<p>Hi</p>\n", encoding="utf-16")
    df = IO.read_csv(spark, p, "Name string, Notes string", sep="\t", encoding="UTF-16", multiline=True)
    assert [(r.Name, r.Notes) for r in df.collect()] == [("Robin", "<p>Hi</p>")]


def test_text_documents_libsvm_xml_json(spark, tmp):
    d = os.path.join(tmp, "docs")
    os.makedirs(d)
    write(os.path.join(d, "a.txt"), "one\ntwo\n")
    write(os.path.join(d, "b.txt"), "three\n")
    assert IO.read_lines(spark, d).count() == 3
    assert IO.read_documents(spark, d).count() == 2
    lib = write(os.path.join(tmp, "x.libsvm"), "1 1:0.5 3:1.0\n0 2:2.0\n")
    assert IO.read_libsvm(spark, lib, 4).count() == 2
    xml = write(os.path.join(tmp, "p.xml"), '<poets><poet><name language="en">Al</name></poet>'
                '<poet><name language="fr">Bé</name></poet></poets>')
    x = IO.read_xml(spark, xml, "poet").collect()
    assert sorted(r.name._language for r in x) == ["en", "fr"]
    js = write(os.path.join(tmp, "page1.json"), json.dumps({"items": [{"id": 1, "d": 5}, {"id": 2, "d": 9}]}))
    items = IO.read_paginated(spark, js, schema="items array<struct<id:int, d:int>>")
    assert rows(items, "id", "d") == [(1, 5), (2, 9)]
    assert IO.counter(spark, 2000, 2010, 3).count() == 4


def test_csv_sinks_roundtrip(spark, tmp):
    df = spark.createDataFrame([(1, "a;b"), (2, "c")], "k int, v string")
    K.write_csv(df, os.path.join(tmp, "out"), sep=";")
    back = IO.read_csv(spark, os.path.join(tmp, "out"), "k int, v string", sep=";")
    assert rows(back) == [(1, "a;b"), (2, "c")]
    K.write_single_csv(df, os.path.join(tmp, "one"))
    assert len([f for f in os.listdir(os.path.join(tmp, "one")) if f.endswith(".csv")]) == 1


def test_html_fragments_render(spark):
    df = spark.createDataFrame([("Robin", "<p>This is Robin</p>"), ("Nik", "a b")], "Name string, Notes string")
    frags = K.html_fragments(df.withColumn("k", F.monotonically_increasing_id()), ["Name", "Notes"], ["k"], "Report")
    text = "".join(r.html for r in K.render(frags).collect())
    assert text.startswith('\n<html>\n<head>\n<title>Report</title></head>\n<body>\n<table border="1">\n<tr>\n<th>Name</th>')
    assert "\n<tr>\n<td>Robin</td>\n<td><p>This is Robin</p></td></tr>" in text and "a&#160b" in text
    assert text.endswith("</table></body></html>")


def trades(spark):
    # buy 10, sell 4, sell 20 (ignored), buy 1, sell 7; user 2 only sells.
    rows_ = [(1, 1, 10.0), (1, 2, -4.0), (1, 3, -20.0), (1, 4, 1.0), (1, 5, -7.0), (2, 1, -3.0)]
    return spark.createDataFrame([(u, f"2024-01-01 00:00:{s:02d}", s, d) for u, s, d in rows_],
                                 "user_id long, ts string, event_id long, delta double")


def test_portfolio_fold_batch(spark):
    out = rows(S.portfolio_fold(trades(spark), "user_id", ["ts", "event_id"], "delta"), "user_id", "owned")
    assert out == [(1, 0.0)]


def late_trades(spark):
    """Whole-second stamps (order by id within one), null keys, rows out of
    order across slices, and one user with most of the rows."""
    import random
    r = random.Random(9)
    data = []
    for i in range(1200):
        user = None if i % 11 == 0 else (0 if i % 3 else r.randint(1, 6))
        data.append((user, f"2024-0{1 + i // 400}-01 00:{i // 60 % 60:02d}:{i // 7 % 60:02d}", i,
                     float(r.randint(1, 9)) if r.random() < 0.6 else -float(r.randint(1, 12))))
    return spark.createDataFrame(data, "user_id long, ts string, event_id long, delta double").withColumn(
        "ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize("per_batch", [1])
def test_portfolio_stream_matches_batch(spark, tmp, per_batch):
    df = late_trades(spark)
    src = os.path.join(tmp, "in")
    for lo in range(0, 1200, 200):  # the slices of a month arrive in swapped order
        lo = lo + 200 if lo // 200 % 2 == 0 else lo - 200
        df.where((F.col("event_id") >= lo) & (F.col("event_id") < lo + 200)).coalesce(1).write.mode("append").parquet(src)
    fold = S.PortfolioStream(spark, os.path.join(tmp, "fold"), "user_id", ["ts", "event_id"], "delta", "2 hours")
    q = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(src)
         .writeStream.foreachBatch(fold.step).option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    want = rows(S.portfolio_fold(df, "user_id", ["ts", "event_id"], "delta"), "user_id", "owned", "trades")
    assert rows(fold.result(), "user_id", "owned", "trades") == want
    assert len(want) == len({r.user_id for r in df.collect()}) and fold.quarantine().count() == 0
    # All three forms agree, null keys are one group.
    assert rows(S.portfolio_fold(df, "user_id", ["ts", "event_id"], "delta", split=True), "user_id", "owned", "trades") == want


def test_portfolio_stream_quarantines_late_rows(spark, tmp):
    ts = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp"))
    fold = S.PortfolioStream(spark, os.path.join(tmp, "fold"), "user_id", ["ts", "event_id"], "delta", "1 second")
    one = ts(trades(spark))
    fold.step(one.where("event_id >= 2"), 0)
    fold.step(one.where("event_id = 1 and user_id = 1"), 1)
    assert [(r.user_id, r.event_id) for r in fold.quarantine().collect()] == [(1, 1)]
    assert rows(fold.result(), "user_id", "owned", "trades") == [(1, 1.0, 4)]


def test_chain_positions(spark):
    nodes = spark.createDataFrame([("c", "d"), ("a", "b"), ("d", None), ("b", "c"), ("x", None), ("y", "x")],
                                  "id string, next string")
    got = dict((r.id, (r.tail, r.pos)) for r in C.chain_positions(nodes).collect())
    assert got == {"a": ("d", 0), "b": ("d", 1), "c": ("d", 2), "d": ("d", 3), "y": ("x", 0), "x": ("x", 1)}


def test_chain_positions_long_and_cyclic(spark):
    nodes = [(f"n{i}", f"n{i + 1}") for i in range(150)] + [("n150", None), ("a", "b"), ("b", "a"), ("to", "a"), ("gone", "nowhere")]
    got = {r.id: (r.tail, r.pos) for r in C.chain_positions(spark.createDataFrame(nodes, "id string, next string")).collect()}
    assert all(got[f"n{i}"] == ("n150", i) for i in range(151))
    assert got["a"] == got["b"] == got["to"] == (None, None) and got["gone"] == ("gone", 0)


def test_page_chain_in_order(spark, tmp):
    pages = {"z1": {"items": ["1", "2"], "next": "p2"}, "p2": {"items": ["3"], "next": "a3"}, "a3": {"items": [], "next": "q4"},
             "q4": {"items": ["4"], "next": None}}
    for k, v in pages.items():
        write(os.path.join(tmp, f"{k}.json"), json.dumps(v))
    got = C.read_page_chain(spark, tmp).orderBy("page_pos", "item_pos").collect()
    assert [(r.page, r.item_pos, r.item) for r in got] == [("z1", 0, "1"), ("z1", 1, "2"), ("p2", 0, "3"), ("q4", 0, "4")]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["l_partkey", "mean", "stddev"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_poets_xml_text_roundtrip(spark):
    # Poets with names in two languages, written as XML text and read back.
    df = spark.createDataFrame(
        [([("Homer", "en"), ("Omero", "it")],), ([("Virgil", "en"), ("Virgilio", "it")],)],
        "names array<struct<name: string, language: string>>")
    xml = K.to_xml_text(df, ["names"], "poet")
    schema = "names array<struct<name: string, language: string>>"
    back = xml.select(F.from_xml("xml", schema).alias("p")).select("p.names")
    assert sorted(str(r.names) for r in back.collect()) == sorted(str(r.names) for r in df.collect())


def test_int_pairs_as_maps_and_dated_events(spark, tmp):
    from tessera.operators.relational import row_as_map

    p = write(os.path.join(tmp, "pairs.csv"), "x,y\n3,5\n8,13\n")
    df = IO.read_csv(spark, p, "x int, y int")
    maps = [r.m for r in df.select(row_as_map(df).alias("m")).collect()]
    assert maps == [{"x": "3", "y": "5"}, {"x": "8", "y": "13"}] and [r.y for r in df.collect()] == [5, 13]
    e = write(os.path.join(tmp, "events.csv"), "event,date\nmilestone 1,2016-03-08\nmilestone 2,2016-03-15\n")
    ev = IO.read_csv(spark, e, "event string, date timestamp").collect()
    assert [str(r.date.date()) for r in ev] == ["2016-03-08", "2016-03-15"]


def test_read_through_cache_batch_and_stream(spark, tmp):
    import time

    from tessera.streaming.cache import read_through, read_through_stream

    prices = spark.createDataFrame([("GE", 9.29), ("AMD", 20.23), ("AAPL", 207.48)], "symbol string, price double")
    cache_path = os.path.join(tmp, "cache")
    spark.createDataFrame([("GE", 9.0)], "symbol string, price double").write.parquet(cache_path)
    keys = spark.createDataFrame([("GE",), ("AMD",), ("XYZ",)], "symbol string")
    fulfill = lambda missing: missing.join(prices, "symbol")
    got = {r.symbol: (r.price, r.source) for r in read_through(keys, "symbol", spark.read.parquet(cache_path), "price", fulfill).collect()}
    assert got == {"GE": (9.0, "cache"), "AMD": (20.23, "fulfilled"), "XYZ": (None, "missing")}

    # Stream: the cache table is re-read for every micro-batch.
    src = os.path.join(tmp, "keys")
    keys.where("symbol = 'AMD'").coalesce(1).write.parquet(src)
    seen = []

    def sink(df, batch_id):
        seen.extend((batch_id, r.symbol, r.source) for r in df.collect())
        # After the first batch the cache learns AMD's price.
        spark.createDataFrame([("AMD", 20.0)], "symbol string, price double").write.mode("append").parquet(cache_path)

    stream = spark.readStream.schema("symbol string").option("maxFilesPerTrigger", 1).parquet(src)
    q = read_through_stream(stream, "symbol", lambda: spark.read.parquet(cache_path), "price", fulfill, sink,
                            os.path.join(tmp, "ck"))
    q.awaitTermination()
    time.sleep(0.05)
    keys.where("symbol = 'AMD'").coalesce(1).write.mode("append").parquet(src)
    q = read_through_stream(stream, "symbol", lambda: spark.read.parquet(cache_path), "price", fulfill, sink,
                            os.path.join(tmp, "ck"))
    q.awaitTermination()
    assert [s for _, _, s in seen] == ["fulfilled", "cache"]


def test_read_through_expiry(spark):
    import datetime as dt

    from tessera.streaming.cache import read_through

    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    cache = spark.createDataFrame([("GE", 9.0, now - dt.timedelta(seconds=30)), ("AMD", 1.0, now - dt.timedelta(hours=2))],
                                  "symbol string, price double, cached_at timestamp")
    prices = spark.createDataFrame([("GE", 9.29), ("AMD", 20.23)], "symbol string, price double")
    keys = spark.createDataFrame([("GE",), ("AMD",)], "symbol string")
    got = read_through(keys, "symbol", cache, "price", lambda m: m.join(prices, "symbol"),
                       now=F.lit(now), ttl_seconds=60).collect()
    assert {r.symbol: (r.price, r.source) for r in got} == {"GE": (9.0, "cache"), "AMD": (20.23, "fulfilled")}


@pytest.mark.parametrize("regime", ["rich", "tight"])
def test_portfolio_fold_split_matches_sequential(spark, regime):
    import random

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        rnd = random.Random(11 if regime == "rich" else 12)
        data = []
        for i in range(6000):
            user = 0 if rnd.random() < 0.35 else rnd.randint(1, 40)
            if regime == "rich":  # holdings stay high: stretches chain without replay
                d = float(rnd.randint(50, 100)) if rnd.random() < 0.7 else -float(rnd.randint(1, 20))
            else:  # sells often exceed holdings: replays are needed
                d = float(rnd.randint(1, 10)) if rnd.random() < 0.5 else -float(rnd.randint(1, 15))
            data.append((user, f"2024-01-01 {i // 3600:02d}:{(i // 60) % 60:02d}:{i % 60:02d}", i, d))
        df = spark.createDataFrame(data, "user_id long, ts string, event_id long, delta double").repartition(7)
        a = rows(S.portfolio_fold(df, "user_id", ["ts", "event_id"], "delta", split=False), "user_id", "owned", "trades")
        b = rows(S.portfolio_fold(df, "user_id", ["ts", "event_id"], "delta", split=True), "user_id", "owned", "trades")
        assert a == b
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _run_portfolio(spark, src, base, schema, delay):
    from tessera.streaming import portfolio as P

    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = P.start(s, f"{base}/ck", f"{base}/late", "user_id", ["ts", "event_id"], "delta", delay)
    q.awaitTermination()


def test_portfolio_state_store_survives_a_restart(spark, tmp):
    """Rows out of order, null keys and one hot user; the query is stopped and
    a new one started on the same checkpoint between slices."""
    from tessera.streaming import portfolio as P

    df = late_trades(spark)
    src = os.path.join(tmp, "in")
    for k, lo in enumerate((200, 0, 600, 400, 1000, 800)):
        df.where((F.col("event_id") >= lo) & (F.col("event_id") < lo + 200)).coalesce(1).write.mode("append").parquet(src)
        if k in (2, 5):  # three slices in one query, the rest in the next
            _run_portfolio(spark, src, tmp, df.schema, "2 hours")
    want = rows(S.portfolio_fold(df, "user_id", ["ts", "event_id"], "delta"), "user_id", "owned", "trades")
    assert rows(P.holdings(spark, f"{tmp}/ck", "user_id"), "user_id", "owned", "trades") == want
    assert P.late_rows(spark, f"{tmp}/late", "user_id", ["ts", "event_id"], "delta").count() == 0


def test_portfolio_state_store_late_rows(spark, tmp):
    from tessera.streaming import portfolio as P

    def land(data):
        df = spark.createDataFrame(data, "user_id long, ts string, event_id long, delta double").withColumn(
            "ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(os.path.join(tmp, "in"))
        return df.schema

    land([(1, "2024-01-01 00:00:00", 1, 10.0), (1, "2024-01-03 00:00:00", 2, 5.0), (2, None, 3, 2.0)])
    land([(3, "2024-01-09 00:00:00", 4, 1.0)])  # moves the watermark past both trades of user 1
    land([(3, "2024-01-09 01:00:00", 7, 1.0)])  # the batch in which they are folded
    schema = land([(1, "2024-01-02 00:00:00", 5, -8.0), (1, "2024-01-09 12:00:00", 6, -4.0)])
    _run_portfolio(spark, os.path.join(tmp, "in"), tmp, schema, "1 day")
    late = P.late_rows(spark, f"{tmp}/late", "user_id", ["ts", "event_id"], "delta").collect()
    assert [(r.user_id, str(r.ts), r.event_id, r.delta) for r in late] == [(1, "2024-01-02 00:00:00", 5, -8.0)]
    assert rows(P.holdings(spark, f"{tmp}/ck", "user_id"), "user_id", "owned", "trades") == [
        (1, 11.0, 3), (2, 2.0, 1), (3, 2.0, 2)]


def test_portfolio_batches_survive_a_new_object(spark, tmp):
    df = trades(spark).withColumn("ts", F.col("ts").cast("timestamp"))
    make = lambda: S.PortfolioStream(spark, os.path.join(tmp, "fold"), "user_id", ["ts", "event_id"], "delta", "1 second")
    make().step(df.where("event_id <= 2"), 0)
    make().step(df.where("event_id > 2"), 1)
    fold = make()
    assert rows(fold.result(), "user_id", "owned", "trades") == [(1, 0.0, 5)]
    assert fold.quarantine().count() == 0


def test_step_pieces_against_fold():
    import random
    from bisect import bisect_right

    import numpy as np

    r = random.Random(2)
    for _ in range(200):
        ds = [float(r.choice([-1, -1, 1]) * r.randint(0, 12)) for _ in range(r.randint(0, 30))]
        known = (np.zeros(1), np.zeros(1))
        for d in ds:
            known = S._step_pieces(*known, d)
        for x in range(0, 80, 3):
            want = float(x)
            for d in ds:
                want = S.apply_trade(want, d)
            start, add = known
            assert x + add[bisect_right(start.tolist(), x) - 1] == want


@pytest.mark.parametrize("pieces", [1, 512])
def test_split_fold_replays_only_the_stretch(spark, pieces, monkeypatch):
    """With one piece a stretch every entry below its threshold is replayed."""
    import random

    monkeypatch.setattr(S, "MAX_PIECES", pieces)
    r = random.Random(5)
    data = [(i % 7 and 0, i, float(r.randint(1, 9)) if r.random() < 0.5 else -float(r.randint(1, 14))) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, i long, d double").repartition(6)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        want = rows(S.portfolio_fold(df, "k", ["i"], "d"), "k", "owned", "trades")
        assert rows(S.portfolio_fold(df, "k", ["i"], "d", split=True), "k", "owned", "trades") == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_slow_calls_are_timed_out(spark):
    """Sleeping rows are marked, ended ones and failed ones keep their result."""
    import time

    from tessera.operators.deadline import call_within

    def work(x):
        if x is None:
            raise ValueError("nothing to do")
        time.sleep(x)
        return int(x * 10)

    df = spark.createDataFrame([(1, 0.0), (2, 60.0), (3, 0.1), (4, None), (5, 60.0), (6, 0.2)], "i long, s double").coalesce(1)
    df = df.selectExpr("i", "CASE WHEN i = 4 THEN NULL ELSE CAST(s AS STRING) END AS s")
    began = time.time()
    got = {r.i: (r.status, r.value, r.error) for r in call_within(
        df, "s", lambda x: work(None if x is None else float(x)), "bigint", seconds=4).collect()}
    assert time.time() - began < 50
    assert got == {1: ("done", 0, None), 2: ("timed out", None, "not done within 4 s"), 3: ("done", 1, None),
                   4: ("failed", None, "ValueError: nothing to do"), 5: ("timed out", None, "not done within 4 s"),
                   6: ("done", 2, None)}


def test_first_come_first_served(spark, tmp):
    from tessera.streaming import merge as MG

    schema = "k long, at long"
    land = lambda name, data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp}/{name}")
    for batch in ({"a": [(1, 5)], "b": [(1, 3), (2, 9)]}, {"a": [(2, 0), (3, 1)], "b": []}, {"b": [(3, 0), (4, 4)]}):
        for name in ("a", "b"):
            land(name, batch.get(name, []))
        streams = {n: spark.readStream.schema(schema).parquet(f"{tmp}/{n}") for n in ("a", "b")}
        MG.start_merge(streams, f"{tmp}/out", f"{tmp}/ck").awaitTermination()
    got = MG.merged(spark, f"{tmp}/out")
    assert rows(MG.first_come(got, "k", "at"), "k", "at", "source", "arrival") == [
        (1, 3, "b", 0), (2, 9, "b", 0), (3, 1, "a", 1), (4, 4, "b", 2)]
    assert got.count() == 7


def test_cache_entries_expire_in_a_stream(spark, tmp):
    """A new object for every batch: the cache is the table, not the process."""
    from tessera.streaming.cache import ExpiringCache

    prices = {"v": spark.createDataFrame([("GE", 1.0), ("IBM", 2.0)], "s string, price double")}

    def step(i, data):
        df = spark.createDataFrame(data, "s string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
        cache = ExpiringCache(spark, tmp, "s", "price", "ts", 3600, lambda m: m.join(prices["v"], "s"))
        cache.step(df, i)
        return {r.s: (r.price, r.source) for r in spark.read.parquet(f"{tmp}/lookups/{i}").collect()}

    assert step(0, [("GE", "2024-01-01 10:00:00"), ("X", "2024-01-01 09:00:00")]) == {"GE": (1.0, "fulfilled"), "X": (None, "missing")}
    prices["v"] = spark.createDataFrame([("GE", 7.0), ("IBM", 8.0)], "s string, price double")
    assert step(1, [("GE", "2024-01-01 10:59:00"), ("IBM", "2024-01-01 10:30:00")]) == {"GE": (1.0, "cache"), "IBM": (8.0, "fulfilled")}
    assert step(2, [("GE", "2024-01-01 11:01:00"), ("IBM", "2024-01-01 11:01:00")]) == {"GE": (7.0, "fulfilled"), "IBM": (8.0, "cache")}
    assert step(2, [("GE", "2024-01-01 11:01:00")]) == {"GE": (7.0, "fulfilled")}  # run again: from the version before
    assert spark.read.parquet(f"{tmp}/cache/2").count() == 2
