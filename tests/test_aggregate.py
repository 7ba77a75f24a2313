import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import aggregate as A
from tessera.operators import relational as R
from tessera.operators import text as X

# Literal ratings fixture (movieId, rating) from the reference's analyzer spec.
RATINGS = [(1, 4.0), (1, 3.0), (2, 2.0), (2, 2.5), (2, 3.0)]


def test_mean_stddev_per_key(spark):
    df = spark.createDataFrame(RATINGS, "movieId int, rating double")
    out = {r.movieId: (r.mean, r.stddev) for r in A.mean_stddev(df, "movieId", "rating").collect()}
    assert out[1][0] == pytest.approx(3.5) and out[1][1] == pytest.approx(math.sqrt(0.5))
    assert out[2][0] == pytest.approx(2.5) and out[2][1] == pytest.approx(0.5)


def test_mean_stddev_empty_and_order_independent(spark):
    empty = spark.createDataFrame([], "movieId int, rating double")
    assert A.mean_stddev(empty, "movieId", "rating").count() == 0
    df = spark.createDataFrame(RATINGS, "movieId int, rating double")
    a = rows(A.mean_stddev(df, "movieId", "rating", digits=9))
    b = rows(A.mean_stddev(df.repartition(5, F.rand(7)), "movieId", "rating", digits=9))
    assert a == b


def test_single_row_group_has_null_deviation(spark):
    df = spark.createDataFrame([(9, 1.0)], "movieId int, rating double")
    assert A.mean_stddev(df, "movieId", "rating").first().stddev is None


def test_word_count_golden(spark):
    lines = spark.createDataFrame([("Hello World",)] * 3 + [("Hi",)], "text string")
    out = X.word_count(lines).collect()
    assert [(r.word, r["count"]) for r in out] == [("Hello", 3), ("World", 3), ("Hi", 1)]


def test_clean_word_count_strips_and_lowers(spark):
    lines = spark.createDataFrame([("How much wood, would a WOODCHUCK chuck?",), ("(wood) 'wood' -wood-",)], "text string")
    out = dict((r.word, r["count"]) for r in X.word_count(lines, clean=True).collect())
    assert out["wood"] == 4 and out["woodchuck"] == 1 and out["chuck"] == 1


def test_words_per_group_with_total(spark):
    df = spark.createDataFrame([("a", "one two three"), ("a", "four"), ("b", " five  six ")], "host string, text string")
    out = dict((r.host, r.words) for r in X.words_per_group_with_total(df, "host", "text").collect())
    assert out == {"a": 4, "b": 2, None: 6}


# Literal prices and positions from the reference's portfolio spec.
PRICES = [("GE", 9.29), ("AMD", 20.23), ("AAPL", 207.48), ("BAC", 27.89), ("ECA", 8.55), ("MSFT", 106.16),
          ("GOOG", 1057.79)]


@pytest.mark.parametrize("positions,expected", [
    ([("p", "MSFT", 100.0)], 10616.0), ([("p", "MSFT", 55.67), ("p", "GOOG", 43.20)], 51606.4552), ([], 0.0)])
def test_portfolio_value(spark, positions, expected):
    prices = spark.createDataFrame(PRICES, "symbol string, price double")
    pos = spark.createDataFrame(positions, "portfolio string, symbol string, quantity double")
    ports = spark.createDataFrame([("p",)], "portfolio string")
    priced = R.lookup(pos, R.first_per_key(prices, "symbol", ["price"], "price"), "symbol", "inner")
    value = priced.groupBy("portfolio").agg(F.sum(F.col("quantity") * F.col("price")).alias("value"))
    got = ports.join(value, "portfolio", "left").select(F.coalesce("value", F.lit(0.0)).alias("v")).first().v
    assert got == pytest.approx(expected)


def test_unmatched_lookup_is_an_error_row(spark):
    prices = spark.createDataFrame(PRICES[:2], "symbol string, price double")
    pos = spark.createDataFrame([("AAPL",), ("GE",)], "symbol string")
    errs = R.lookup_errors(pos, prices, "symbol").collect()
    assert [(e.symbol, e.error) for e in errs] == [("AAPL", "no entry matching AAPL")]


def test_uncertain_sums(spark):
    df = spark.createDataFrame([("k", 2.0, 2.0, 0.1), ("k", 2.0, 2.0, 0.1)], "k string, mu double, sd double, d double")
    r = A.sum_with_uncertainty(df, ["k"], "mu", sigma="sd", delta="d").first()
    assert r.mu == 4.0 and r.sigma == pytest.approx(2 * math.sqrt(2), abs=1e-6) and r.delta == pytest.approx(0.2)


def test_describe_and_summary_shapes(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    d = A.describe_long(df, ["x"]).first()
    assert (d.n, d.min_value, d.max_value, d.mean) == (100, 1.0, 100.0, 50.5)
    s = A.quartile_summary(df, "x").first()
    assert (s.q25, s.q50, s.q75) == (25.0, 50.0, 75.0)


def test_corr_pairs_are_ordered_both_ways(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 3.0), (3.0, 7.0, 1.0)], "a double, b double, c double")
    out = {(r.x, r.y): r.corr for r in A.pairwise_corr(df, ["a", "b", "c"]).collect()}
    assert len(out) == 6 and out[("a", "b")] == out[("b", "a")] and out[("a", "c")] == pytest.approx(-1.0)


def test_last_duplicate_wins(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "k int, pos int, v string")
    assert rows(A.last_wins(df, "k", ["pos"], ["v"])) == [(1, "y"), (2, "z")]


def test_map_reduce_with_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "k string, v double")
    out = A.map_reduce(df, {"k": F.col("k"), "v": F.col("v")}, "k", F.sum, zero=0.0)
    assert rows(out) == [("a", 3.0), ("b", 0.0)]


def test_document_frequency_from_occurrences(spark):
    # Occurrence fixture shape (word -> the pages it occurs in): "the" in 3, "Syria" in 2.
    occ = spark.createDataFrame([("the", ["u1", "u2", "u3"]), ("Syria", ["u1", "u3"])], "word string, urls array<string>")
    pairs = occ.select("word", F.explode("urls").alias("url"))
    out = dict((r.word, r.n) for r in pairs.groupBy("word").agg(F.countDistinct("url").alias("n")).collect())
    assert out == {"the": 3, "Syria": 2}


def test_fold_values_into_ordered_list(spark):
    # Values folded into a list per key, in the order given by a position column.
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 1, "x"), ("k", 3, "c")], "key string, pos int, v string")
    lists = df.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("vs"))
    assert dict((r.key, r.vs) for r in lists.collect()) == {"k": ["a", "b", "c"], "j": ["x"]}


def test_fround_rounds_the_binary_value(spark):
    from tessera.functions.numeric import fround

    df = spark.createDataFrame([(259421.5,), (-2.5,), (0.125,), (1e300,)], "x double")
    got = [r.r for r in df.select(fround(F.col("x") / 1000, 3).alias("r")).collect()]
    # 259.4215 is stored as 259.42149999..., so it rounds down (Spark's round would give 259.422).
    assert got[0] == 259.421 and got[1] == -0.003 and got[3] == 1e297
    assert df.select(fround("x", 0).alias("r")).collect()[1].r == -3.0


def test_quartiles_of_ties_infinities_and_large_columns(spark):
    import random

    r = random.Random(4)
    cases = [[5.0] * 30_000, [float("inf"), float("-inf"), 1.0, 1.0, 2.0], [None, 3.0], [],
             [10.0 ** r.randint(-300, 300) * r.choice([-1, 1]) for _ in range(40_000)],
             [float(r.randint(0, 3)) for _ in range(20_000)] + [r.random() for _ in range(20_000)]]
    for xs in cases:
        df = spark.createDataFrame([(v,) for v in xs], "x double").repartition(3)
        got = A.quartile_summary(df, "x").first()
        known = sorted(v for v in xs if v is not None)
        want = [known[max(1, math.ceil(q * len(known))) - 1] if known else None for q in (0.25, 0.5, 0.75)]
        assert [got.q25, got.q50, got.q75] == want and got.n == len(known)
