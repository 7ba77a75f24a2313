"""Invariants from the test strategy: empty input gives empty output (or
the defined zero), and nulls do not break grouping."""

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import aggregate as A
from tessera.operators import graph as G
from tessera.operators import ordered as O
from tessera.operators import text as X
from tessera.streaming import chains as C
from tessera.streaming import state as S


def test_empty_inputs(spark):
    seq = spark.createDataFrame([], "g string, pos int, value int")
    assert O.run_length_encode(seq, "g", "pos", "value").count() == 0
    assert O.global_row_number(seq, ["pos"]).count() == 0
    assert O.nth_from_start_and_end(seq, "g", "pos", "value", 2).count() == 0
    assert O.is_palindrome(seq, "g", ["pos"], "value").count() == 0
    assert O.three_sum_values(seq, "value", 0).count() == 0
    iv = spark.createDataFrame([], "day string, s int, e int")
    assert O.max_concurrency(iv, "day", "s", "e").count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert X.word_count(docs).count() == 0 and X.concordance(docs).count() == 0
    links = spark.createDataFrame([], "src string, dst string")
    seeds = spark.createDataFrame([], "url string")
    assert G.crawl(links, seeds, 3).count() == 0
    nodes = spark.createDataFrame([], "id string, parent string, key bigint")
    assert G.tree_paths(nodes).count() == 0
    assert C.chain_positions(spark.createDataFrame([], "id string, next string")).count() == 0
    trades = spark.createDataFrame([], "user_id long, ts string, event_id long, delta double")
    assert S.portfolio_fold(trades, "user_id", ["ts", "event_id"], "delta").count() == 0
    pts = spark.createDataFrame([], "i int")
    wheel = spark.createDataFrame([("a", 0, 2)], "event string, lo int, hi int")
    assert O.range_lookup(pts, "i", wheel, "lo", "hi").count() == 0
    assert A.null_counts(spark.createDataFrame([], "a int, b string")).first().asDict() == {"a": 0, "b": 0}


def test_null_group_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 5), (None, 3, 6), ("a", 1, 5)], "g string, pos int, value int")
    enc = rows(O.run_length_encode(df, "g", "pos", "value"), "g", "run_no", "n", "value")
    assert enc == [("a", 1, 1, 5), (None, 1, 2, 5), (None, 2, 1, 6)]


def test_single_row_groups(spark):
    df = spark.createDataFrame([("a", 1, 7)], "g string, pos int, value int")
    r = O.nth_from_start_and_end(df, "g", "pos", "value", 1).first()
    assert (r.last, r.penultimate, r.kth) == (7, None, 7)
    assert O.is_palindrome(df, "g", ["pos"], "value").first().is_palindrome is True
    assert A.mean_stddev(df, "g", "value").first().stddev is None
