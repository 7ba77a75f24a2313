import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import ordered as O
from tessera.operators import records as REC
from tessera.operators import relational as R


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, s string, x double")
    assert R.select_positions(df, [2, 0]).columns == ["x", "k"]
    assert R.select_known(df, ["x", "nope", "k"]).columns == ["x", "k"]
    assert df.select(R.optional_column(df, "nope").alias("n")).first().n is None
    assert R.snake_case("movieTitle") == "movie_title" and R.snake_case("actor2Name") == "actor_2_name"
    renamed = R.rename_columns(df.toDF("orderKey", "custName", "totalPrice"), {"custName": "customer"},
                               prefix={"totalPrice": "order"})
    assert renamed.columns == ["order_key", "customer", "order_total_price"]
    m = df.select(R.row_as_map(df, ["k", "s"]).alias("m")).first().m
    assert m == {"k": "1", "s": "a"}
    fm = R.flat_map(df, ["k"], {"x": F.col("x"), "double": F.col("x") * 2})
    assert rows(fm, "kind", "value") == [("double", 4.0), ("x", 2.0)]


def test_find_first_and_error(spark):
    df = spark.createDataFrame([(2, "dog"), (1, "cat"), (3, "dog")], "k int, pet string")
    assert R.find_first(df, F.col("pet") == "dog", ["k"]).first().k == 2
    with pytest.raises(Exception, match="no row matches"):
        R.find_first(df, F.col("pet") == "bird", ["k"]).collect()


def test_filter_and_negation_drop_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    a, b = R.split_by(df, F.col("x") > 2)
    assert (a.count(), b.count()) == (1, 1)


def test_set_operations(spark):
    pool = spark.createDataFrame([(1,), (1,), (2,), (3,)], "seat int")
    held = spark.createDataFrame([(1,), (3,)], "seat int")
    assert sorted(r.seat for r in pool.exceptAll(held).collect()) == [1, 2]
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert rows(R.map_union(left, right, "k", "v")) == [("a", 1), ("b", 20), ("c", 30)]


def test_sort_orders(spark):
    # Literal composite rows and digit strings from the reference's sort specs.
    comp = spark.createDataFrame([(3, "c"), (1, "a"), (1, "z"), (2, "b")], "i int, s string")
    a = [(r.i, r.s) for r in O.global_row_number(comp, ["i", "s"], "p").orderBy("p").collect()]
    assert a == [(1, "a"), (1, "z"), (2, "b"), (3, "c")]
    b = [(r.i, r.s) for r in O.global_row_number(comp, [F.col("i").desc(), F.col("s").desc()], "p").orderBy("p").collect()]
    assert b == [(3, "c"), (2, "b"), (1, "z"), (1, "a")]
    digits = spark.createDataFrame([(x,) for x in ["31415926535897932384626433832795", "1", "3", "10", "3", "5"]], "s string")
    got = [r.s for r in digits.orderBy(*R.numeric_string_order("s")).collect()]
    assert got == ["1", "3", "3", "5", "10", "31415926535897932384626433832795"]
    suits = spark.createDataFrame([("Hearts",), ("Spades",), ("Clubs",)], "suit string")
    order = R.rank_list_position("suit", ["Spades", "Hearts", "Diamonds", "Clubs"])
    assert [r.suit for r in suits.orderBy(order).collect()] == ["Spades", "Hearts", "Clubs"]
    assert [r.k for r in R.top_k(spark.range(10).withColumnRenamed("id", "k"), 3, [F.col("k").desc()]).collect()] == [9, 8, 7]


def test_weighted_product(spark):
    a = spark.createDataFrame([("red", 3), ("blue", 2)], "ca string, wa int")
    b = spark.createDataFrame([("x", 5)], "cb string, wb int")
    assert rows(R.weighted_product(a, b, "wa", "wb"), "ca", "weight") == [("blue", 10), ("red", 15)]


def _movie_csv(path):
    # Three invented rows in the 28-column movie metadata layout; the last
    # has an unparseable content rating.
    header = ",".join(REC.MOVIE_COLUMNS)
    base = ["Color", "Jane Q. Director", "100", "120", "5", "6", "Actor Two", "7", "1000", "Drama|Comedy|", "Actor One",
            "A Film ", "500", "900", "Actor Three", "0", "sea|ship", "http://x/1", "40", "English", "New Zealand",
            "PG-13", "2000000", "2009", "8", "7.5", "2.35", "33"]
    second = list(base)
    second[11], second[20], second[21], second[0] = "Other Film", "USA", "R", "Black and White"
    third = list(base)
    third[11], third[21] = "Bad Film", "PG-XX"
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n")
        for r in (base, second, third):
            f.write(",".join(r) + "\n")
    return path


def test_movie_records_forgiving(spark, tmp):
    from tessera.operators import policies as P
    from tessera.sources.files import read_csv

    schema = ", ".join(f"{c} string" for c in REC.MOVIE_COLUMNS)
    raw = read_csv(spark, _movie_csv(os.path.join(tmp, "movies.csv")), schema)
    recs = REC.movie_records(raw)
    ok, bad = P.forgiving(recs)
    assert ok.count() == 2 and [r.error for r in bad.collect()] == ["bad content_rating"]
    first = ok.where("title = 'A Film'").first()
    assert first.format.color is True and first.format.duration == 120 and first.production.budget == 2000000
    assert first.reviews.content_rating.code == "PG" and first.reviews.content_rating.age == 13
    assert first.director.name.middle == "Q." and first.genres == ["Drama", "Comedy"]
    assert [r.title for r in REC.movies_from_country(recs, "New Zealand").collect()] == ["A Film"]


def test_merged_page_chains(spark, tmp):
    import json

    from tessera.streaming import chains as C

    for name, pages in {"a": {"a1": ["x", "a2"], "a2": ["y", None]}, "b": {"b1": ["z", None]}}.items():
        d = os.path.join(tmp, name)
        os.makedirs(d)
        for tok, (item, nxt) in pages.items():
            with open(os.path.join(d, f"{tok}.json"), "w") as f:
                json.dump({"items": [{"v": item}], "next": nxt}, f)
    both = [C.read_page_chain(spark, os.path.join(tmp, n), "struct<v:string>").select("tail", "page_pos", "item.v") for n in "ab"]
    merged = C.merge_chains(both, "v", str.upper, "string", "out")
    got = [(r.tail, r.page_pos, r.out) for r in merged.orderBy("tail", "page_pos").collect()]
    assert got == [("a2", 0, "X"), ("a2", 1, "Y"), ("b1", 0, "Z")]
