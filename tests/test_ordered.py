import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.scalar import hhmm_minutes
from tessera.operators import ordered as O


def seq(spark, values, name="value"):
    return spark.createDataFrame([("g", i, v) for i, v in enumerate(values)], f"g string, pos int, {name} int")


@pytest.mark.parametrize("meetings,rooms", [([(500, 800), (600, 800)], 2),
                                            ([(900, 1000), (400, 900), (400, 1700)], 2), ([], 0)])
def test_meeting_rooms(spark, meetings, rooms):
    df = spark.createDataFrame([("d", a, b) for a, b in meetings], "day string, start int, stop int")
    df = df.select("day", hhmm_minutes("start").alias("s"), hhmm_minutes("stop").alias("e"))
    out = O.max_concurrency(df, "day", "s", "e").collect()
    assert (out[0].rooms if out else 0) == rooms


def test_occupancy_series_stop_before_start(spark):
    df = spark.createDataFrame([("d", 900, 1000, 1), ("d", 400, 900, 2), ("d", 400, 1700, 3)],
                               "day string, start int, stop int, id int")
    s = O.occupancy_series(df, "day", "start", "stop", tie=["id"]).orderBy("step").collect()
    assert [0] + [r.occupancy for r in s] == [0, 1, 2, 1, 2, 1, 0]


def test_run_length_encoding(spark):
    df = seq(spark, [10, 11, 11, 12, 13, 13, 13, 14, 15, 15, 9])
    enc = O.run_length_encode(df, "g", "pos", "value").orderBy("run_no").collect()
    assert [(r.n, r.value) for r in enc] == [(1, 10), (2, 11), (1, 12), (3, 13), (1, 14), (2, 15), (1, 9)]
    mod = O.run_length_encode(df, "g", "pos", "value", modified=True).orderBy("run_no").collect()
    assert [r.n for r in mod] == [None, 2, None, 3, None, 2, None]
    comp = O.compress(df, "g", "pos", "value").orderBy("pos").collect()
    assert [r.value for r in comp] == [10, 11, 12, 13, 14, 15, 9]
    packed = O.pack(df, "g", "pos", "value").orderBy("run_no").collect()
    assert packed[3].pack == [13, 13, 13]


def test_rle_is_order_independent(spark):
    df = seq(spark, [1, 1, 2, 2, 2, 1, 3, 3])
    a = rows(O.run_length_encode(df, "g", "pos", "value"))
    b = rows(O.run_length_encode(df.repartition(7, F.rand(3)), "g", "pos", "value"))
    assert a == b


def test_replicate(spark):
    df = seq(spark, [1, 1, 2, 3, 5, 8])
    assert O.replicate(df, 2).count() == 12
    assert O.replicate(df, 3).count() == 18
    assert O.replicate(df, 0).count() == 0


def test_nth_palindrome_sorted(spark):
    df = seq(spark, [1, 2, 3, 2, 1])
    r = O.nth_from_start_and_end(df, "g", "pos", "value", 2).first()
    assert (r.last, r.penultimate, r.kth) == (1, 2, 2)
    assert O.is_palindrome(df, "g", ["pos"], "value").first().is_palindrome is True
    assert O.is_palindrome(seq(spark, [1, 2, 3]), "g", ["pos"], "value").first().is_palindrome is False
    assert O.is_sorted(seq(spark, [1, 2, 2, 5]), "g", "pos", "value").first().is_sorted is True
    assert O.is_sorted(df, "g", "pos", "value").first().is_sorted is False


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_global_row_number_matches_a_window(spark, parts):
    df = spark.range(0, 2000).select(((F.col("id") * 7919) % 2003).alias("x"), "id").repartition(parts)
    got = rows(O.global_row_number(df, ["x", "id"], "pos"), "x", "id", "pos")
    want = sorted((r.x, r.id, i + 1) for i, r in enumerate(sorted(df.collect(), key=lambda r: (r.x, r.id))))
    assert got == want


def test_three_sum_counts(spark):
    xs = spark.createDataFrame([(x,) for x in [1, 4, -2, -3, 5, 0, -1, 7, -4, 2]], "x int")
    out = O.three_sum_values(xs, "x", 0).collect()
    assert sum(r.n_triples for r in out) == 8
    dup = spark.createDataFrame([(0,), (0,), (0,), (0,)], "x int")
    assert O.three_sum_values(dup, "x", 0).first().n_triples == 4  # C(4, 3)


def test_range_lookup_wheel(spark):
    # Literal odds from the reference's wheel spec: red 3, blue 2, green 4.
    iv = spark.createDataFrame([("red", 0, 3), ("blue", 3, 5), ("green", 5, 9)], "event string, lo int, hi int")
    pts = spark.createDataFrame([(i,) for i in range(10)], "i int")
    out = dict((r.i, r.event) for r in O.range_lookup(pts, "i", iv, "lo", "hi").collect())
    assert [out[i] for i in range(10)] == ["red"] * 3 + ["blue"] * 2 + ["green"] * 4 + [None]


def test_rank_zip_drops_longer_tail(spark):
    a = spark.createDataFrame([(5.0,), (1.0,), (3.0,)], "v double")
    b = spark.createDataFrame([(2.0,), (10.0,)], "v double")
    z = O.rank_zip(a, b, "v", "v")
    assert rows(z, "rank", "a", "b") == [(1, 1.0, 2.0), (2, 3.0, 10.0)]


def test_periodic_labels(spark):
    df = spark.range(1, 16).withColumnRenamed("id", "n")
    out = dict((r.n, r.labels) for r in O.periodic_labels(df, "n", [("Fizz", 0, 3), ("Buzz", 0, 5)]).collect())
    assert out[15] == ["Fizz", "Buzz"] and out[9] == ["Fizz"] and 7 not in out


def test_segmented_scan_null_keys_and_empty(spark):
    from pyspark.sql import Window as W

    from tessera.operators.scan import segmented_scan

    data = [(None if i % 7 == 0 else i % 3, i, float(i % 5), "x" if i % 2 else None) for i in range(300)]
    df = spark.createDataFrame(data, "k long, t long, v double, c string").repartition(5)
    got = segmented_scan(df, "k", ["t"], sum_col="v", prev_col="c")
    w = W.partitionBy("k").orderBy("t")
    want = df.select("k", "t", F.row_number().over(w).alias("idx"),
                     F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("running"),
                     F.lag("c").over(w).alias("prev"))
    assert rows(got, "k", "t", "idx", "running", "prev") == rows(want, "k", "t", "idx", "running", "prev")
    empty = spark.createDataFrame([], "k long, t long, v double, c string")
    assert segmented_scan(empty, "k", ["t"], sum_col="v", prev_col="c").count() == 0


def test_scan_is_exact_for_longs_nans_and_null_keys(spark):
    big = 9007199254740993
    data = [(None, 1, big, float("nan")), (None, 2, 2, 1.0), (None, 3, None, None), ("a", 1, big, 0.5)]
    df = spark.createDataFrame(data, "k string, t int, v long, x double").repartition(3)
    got = {(r.k, r.t): r for r in O.running_sum(df, "k", ["t"], "v").collect()}
    assert [got[None, t].running for t in (1, 2, 3)] == [big, big + 2, big + 2] and got["a", 1].running == big
    prev = {(r.k, r.t): r.prev for r in O.key_scan(df, "k", ["t"], prev_col="x").collect()}
    assert prev[None, 1] is None and prev[None, 2] != prev[None, 2] and prev[None, 3] == 1.0
    ends = {r.k: (r.last, r.penultimate, r.kth) for r in O.nth_from_start_and_end(df, "k", ["t"], "v", 1).collect()}
    assert ends == {None: (None, 2, big), "a": (big, None, big)}
    down = {(r.k, r.t): r.idx for r in O.key_scan(df, ["k"], [F.desc("t")]).collect()}
    assert down[None, 3] == 1 and down[None, 1] == 3


def test_range_lookup_fractions(spark):
    iv = spark.createDataFrame([(0.0, 10.5, "a"), (10.5, 11.0, "b")], "lo double, hi double, name string")
    pt = spark.createDataFrame([(10.2,), (10.5,), (11.0,), (0.0,)], "x double")
    got = {r.x: r.name for r in O.range_lookup(pt, "x", iv, "lo", "hi").collect()}
    assert got == {10.2: "a", 10.5: "b", 11.0: None, 0.0: "a"}


def test_size_partitions(spark):
    from tessera.session import input_bytes, size_partitions

    old = spark.conf.get("spark.sql.shuffle.partitions")
    n = size_partitions(spark, 10 * (256 << 20))
    assert n >= 10 and spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 << 20)
    assert input_bytes(spark, ["/root/testdata/sf0.001/orders.parquet"]) > 0
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_scan_carries_across_partitions(spark):
    import random

    from pyspark.sql import Window as W

    from tessera.operators.scan import segmented_scan

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        rnd = random.Random(5)
        data = [(0 if rnd.random() < 0.4 else rnd.randint(1, 30), i, None if rnd.random() < 0.05 else float(rnd.randint(0, 9)),
                 rnd.choice("ab")) for i in range(8000)]
        df = spark.createDataFrame(data, "k long, t long, v double, c string").repartition(9)
        spread = df.orderBy("k", "t").select(F.spark_partition_id().alias("p"), "k").where("k = 0")
        assert spread.select("p").distinct().count() > 2  # the hot key really spans partitions
        got = segmented_scan(df, "k", ["t"], sum_col="v", prev_col="c")
        w = W.partitionBy("k").orderBy("t")
        want = df.select("k", "t", F.row_number().over(w).alias("idx"),
                         F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("running"),
                         F.lag("c").over(w).alias("prev"))
        assert rows(got, "k", "t", "idx", "running", "prev") == rows(want, "k", "t", "idx", "running", "prev")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_reverse_positions(spark):
    df = seq(spark, [5, 6, 7])
    out = O.reverse_positions(df, "g", ["pos"], "rpos").orderBy("rpos").collect()
    assert [r.value for r in out] == [7, 6, 5]


def test_range_lookup_on_a_skewed_domain(spark):
    """Intervals from a thousandth to a billion wide, half of the points equal."""
    from bisect import bisect_right

    edges = [0.0] + [10.0 ** k for k in range(-3, 10)]
    iv = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(len(edges) - 1) if i != 4],
                               "name long, lo double, hi double")
    xs = [(i, 0.5 if i % 2 else 10.0 ** (i % 1300 / 100 - 3)) for i in range(4000)] + [(-1, None), (-2, -1.0), (-3, 1e9)]
    got = {r.i: r.name for r in O.range_lookup(spark.createDataFrame(xs, "i long, x double"), "x", iv, "lo", "hi").collect()}

    def plain(x):
        k = None if x is None else bisect_right(edges, x) - 1
        return None if k is None or k < 0 or k == 4 or k >= len(edges) - 1 else k

    assert got == {i: plain(x) for i, x in xs}


def test_runs_across_partitions(spark):
    """One hot key with runs longer than partitions, and keys that change at edges."""
    import random
    from itertools import groupby

    r = random.Random(3)
    data, pos = [], 0
    for key, n in ((None, 40), (0, 3000), (1, 5), (2, 400)):
        while n > 0:
            k = min(n, r.choice([1, 2, 3, 700]))
            v = r.choice(["a", "b", None])
            data += [(key, pos + i, v) for i in range(k)]
            pos, n = pos + k, n - k
    df = spark.createDataFrame(data, "k long, pos long, v string").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = sorted(((x.k is None, x.k or 0, x.run_no, x.n, x.v) for x in O.run_length_encode(df, "k", ["pos"], "v").collect()),
                     key=lambda t: t[:3])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = []
    for key in (0, 1, 2, None):
        for i, (v, rows_) in enumerate(groupby(x[2] for x in data if x[0] == key)):
            want.append((key is None, key or 0, i + 1, len(list(rows_)), v))
    assert got == want


def test_copies_and_packs_in_blocks(spark):
    df = spark.createDataFrame([(1, 7), (2, 0), (3, -2), (4, 3)], "i long, n long")
    got = sorted((r.i, r.copy) for r in O.replicate(df, "n", block=3).collect())
    assert got == [(1, k) for k in range(7)] + [(4, k) for k in range(3)]
    rows_ = spark.createDataFrame([(1, i, "a" if i < 7 else "b") for i in range(8)], "g long, i long, v string")
    packs = sorted((r.run_no, r.part, "".join(r["pack"])) for r in O.pack(rows_, "g", ["i"], "v", block=3).collect())
    assert packs == [(1, 0, "aaa"), (1, 1, "aaa"), (1, 2, "a"), (2, 0, "b")]


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_three_sum_in_blocks_against_brute_force(spark, kind):
    import random
    from collections import Counter
    from itertools import combinations

    r = random.Random(7)
    xs = [r.randint(-60, 60) for _ in range(70)]
    want = Counter(tuple(sorted(c)) for c in combinations(xs, 3) if sum(c) == 5)
    df = spark.createDataFrame([(x,) for x in [*xs, None]], "x long").select(F.col("x").cast(kind))
    got = O.three_sum_values(df, "x", 5, block=7)
    assert {(int(a.x), int(a.y), int(a.z)): a.n_triples for a in got.collect()} == want


def test_three_sum_of_many_distinct_values(spark):
    """100 000 distinct values; the plan has no nested loop and the only sums
    are the planted ones (all values but six are 1 modulo 3, the target 0)."""
    n = 100_000
    df = spark.range(n - 6).select((F.col("id") * 3_000_000 + 1).alias("x")).unionByName(
        spark.createDataFrame([(-5,), (-1,), (6,), (3 * 10**12 + 2,), (-3 * 10**12,), (-2,)], "x long"))
    got = O.three_sum_values(df, "x", 0, block=8192)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert (-3 * 10**12, -2, 3 * 10**12 + 2, 1) in set(map(tuple, got.collect()))


def test_ordered_fold_of_a_hot_key(spark):
    """Matrix products and concatenations do not commute; one key has most rows."""
    import random
    from functools import reduce

    from tessera.operators.scan import fold_fragments, ordered_fold

    r = random.Random(1)
    data = [(None if i % 50 == 0 else 0 if i % 5 else i % 3, i, r.choice("abc")) for i in range(2000)]
    r.shuffle(data)
    df = spark.createDataFrame(data, "k long, i long, v string").repartition(6)
    mats = {"a": (1, 1, 0, 1), "b": (1, 0, 1, 1), "c": (0, 1, 1, 0)}
    mod = 9973

    def product(a, b):
        e = lambda i, j: (a[i] * b[j] + a[i + 1] * b[j + 2]) % mod
        return (e(0, 0), e(0, 1), e(2, 0), e(2, 1))

    def merge(a, b):
        return F.array(*[(a[i] * b[j] + a[i + 1] * b[j + 2]) % mod for i, j in ((0, 0), (0, 1), (2, 0), (2, 1))])

    lit = lambda m: F.array(*[F.lit(x).cast("bigint") for x in m])
    value = F.when(F.col("v") == "a", lit(mats["a"])).when(F.col("v") == "b", lit(mats["b"])).otherwise(lit(mats["c"]))
    want = {}
    for k, _, v in sorted(data, key=lambda x: x[1]):
        want.setdefault(k, []).append(v)
    got = {x.k: tuple(x.folded) for x in ordered_fold(df, "k", ["i"], value, lit((1, 0, 0, 1)), merge).collect()}
    assert got == {k: reduce(product, [mats[v] for v in vs], (1, 0, 0, 1)) for k, vs in want.items()}
    parts = fold_fragments(df, "k", ["i"], F.col("v"), F.lit(""), lambda a, b: F.concat(a, b)).collect()
    for k, vs in want.items():
        assert "".join(p.fragment for p in sorted(parts, key=lambda p: p.part) if p.k == k) == "".join(vs)


def test_rank_zip_splits_equal_values(spark):
    # One value holds nearly all rows; its copies are told apart in the sort.
    a = spark.range(4000).select(F.when(F.col("id") < 3990, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("x"))
    b = spark.range(3000).select(F.col("id").cast("double").alias("y")).unionByName(
        spark.createDataFrame([(None,)], "y double"))
    z = O.rank_zip(a, b, "x", "y")
    got = z.agg(F.count(F.lit(1)), F.sum(F.abs(F.col("a") - F.col("b")))).first()
    assert got[0] == 3000 and got[1] == sum(abs(5.0 - i) for i in range(3000))
    assert z.columns == ["rank", "a", "b"]
