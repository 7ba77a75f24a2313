import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import policies as P


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr("v").alias("r")).first().r


# Literal names from the reference's movie spec.
@pytest.mark.parametrize("name,parts", [
    ("Tom Brady", ("Tom", None, "Brady", None)), ("Noémie Lenoir", ("Noémie", None, "Lenoir", None)),
    ("J.J. Abrams", ("J.", "J.", "Abrams", None)), ("Robert Downey Jr.", ("Robert", None, "Downey", "Jr."))])
def test_person_names(spark, name, parts):
    r = one(spark, S.parse_person_name, name)
    assert (r.first, r.middle, r.last, r.suffix) == parts and r.error is None


@pytest.mark.parametrize("text,code,age,bad", [("PG-13", "PG", 13, False), ("R", "R", None, False),
                                               ("PG-XX", None, None, True)])
def test_content_rating(spark, text, code, age, bad):
    r = one(spark, S.parse_content_rating, text)
    assert (r.code, r.age, r.error is not None) == (code, age, bad)


@pytest.mark.parametrize("text,total,klass", [("6 ft 5 in", 77, "tall"), ("6' 5\"", 77, "tall"), ("8 ft", 96, "giant"),
                                              ("4 ft 2 in", 50, "short")])
def test_heights(spark, text, total, klass):
    r = one(spark, S.parse_height, text)
    assert (r.total_inches, r["class"], r.error) == (total, klass, None)


def test_ssn_date_position_postcode(spark):
    s = one(spark, S.parse_ssn, "123-45-6789")
    assert (s.area, s.grp, s.serial) == (123, 45, 6789)
    d = one(spark, S.parse_dmy, "8/3/2016")
    assert (d.year, d.month, d.day) == (2016, 3, 8)
    p = one(spark, S.parse_position, "MSFT 55.67")
    assert (p.symbol, p.quantity) == ("MSFT", 55.67)
    assert one(spark, S.parse_position, "MSFT 55").error == "cannot parse MSFT 55 as a Position"
    pc = one(spark, S.parse_postcode, "SW1A 9AA")
    assert (pc.area, pc.district, pc.sector, pc.unit) == ("SW", "1A", 9, "AA")


# Literal cells from the reference's cell-typing spec.
@pytest.mark.parametrize("cell,typ", [("1", "int"), ("1.0", "double"), ("true", "boolean"), ("false", "boolean"),
                                      ("yes", "boolean"), ("no", "boolean"), ("T", "boolean"), ('"1"', "string"),
                                      ("2016-03-08", "datetime"), ("hello", "string")])
def test_cell_types(spark, cell, typ):
    assert one(spark, S.cell_type, cell) == typ


def test_dates_in_several_formats(spark):
    fmts = ["yyyy-MM-dd", "MM/dd/yy", "dd MMM yyyy", "MMMM d, yyyy"]
    df = spark.createDataFrame([("2016-03-08",), ("03/08/16",), ("08 Mar 2016",), ("March 8, 2016",), ("junk",)], "s string")
    got = [r.d for r in df.select(S.parse_date_any("s", fmts).cast("date").alias("d")).collect()]
    assert [str(x) for x in got[:4]] == ["2016-03-08"] * 4 and got[4] is None


def test_json_path_branch_is_null(spark):
    df = spark.createDataFrame([('{"a": {"one": 1}}',)], "j string")
    r = df.select(S.json_path("j", "$.a.one").alias("leaf"), S.json_path("j", "$.a").alias("branch")).first()
    assert (r.leaf, r.branch) == ("1", None)


def test_misc_scalars(spark):
    assert one(spark, S.hhmm_minutes, 1730, "int") == 1050
    assert one(spark, S.gender, "F") == "female" and one(spark, S.gender, "x") == "unknown"
    t = one(spark, lambda c: S.convert_temperature(c, "C"), "212")
    assert (t.value, t.unit, t.error) == (100.0, "C", None)
    assert one(spark, lambda c: S.convert_temperature(c, "C"), "hot").error == "invalid input"
    assert one(spark, lambda c: S.contains(c, ""), "abc") is True
    import datetime as dt
    assert one(spark, S.french_long_date, dt.date(1998, 10, 3), "date") == "3 octobre 1998"
    b = S.bucket_between("v", [(0, 10, "a"), (11, 20, "b")])
    assert [one(spark, lambda c: b, x, "double") for x in (5.0, 10.5, 15.0, None)] == ["a", "other", "b", "other"]


def test_policies(spark):
    df = spark.createDataFrame([(1, None), (2, "bad age"), (3, "bad code")], "k int, error string")
    ok, bad = P.forgiving(df)
    assert [r.k for r in ok.collect()] == [1] and sorted(r.k for r in bad.collect()) == [2, 3]
    with pytest.raises(Exception, match="strict parse failed"):
        P.strict(df).collect()
    assert P.strict(df.where("k = 1")).count() == 1
    with pytest.raises(Exception, match="unforgiven"):
        P.forgive_only(df, F.col("error") == "bad age").collect()
    assert P.forgive_only(df.where("k < 3"), F.col("error") == "bad age").count() == 1


def test_per_key_outcome_and_all_or_nothing(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, None), ("b", None, "boom"), ("b", 3.0, None)],
                               "k string, v double, error string")
    ok, errors = P.per_key_outcome(df, "k", F.sum("v"))
    assert [(r.k, r.value) for r in ok.collect()] == [("a", 3.0)]
    e = errors.first()
    assert (e.k, e.message, e.n) == ("b", "boom", 1) and errors.count() == 1
    pair = spark.createDataFrame([(1, 2), (1, None)], "a int, b int").select(
        P.all_or_nothing({"a": F.col("a"), "b": F.col("b")}).alias("p")).collect()
    assert pair[0].p.a == 1 and pair[1].p is None


def test_dates_of_the_parser_spec(spark):
    want = {"2015-09-30": "2015-09-30", "2015-sep-30": "2015-09-30", "2015-SEP-30": "2015-09-30", "30-sep-2015": "2015-09-30",
            "09/30/2015": "2015-09-30", "09-30-2015": "2015-09-30", "sep-30-2015": "2015-09-30", "09/30/15": "2015-09-30",
            "30/09/2015": "2015-09-30", "15-9-3": "2015-09-03", "sap-30-2015": None, "2015-13-01": None, "": None, "30-09": None}
    df = spark.createDataFrame([(x,) for x in want], "x string")
    got = {r.x: None if r.d is None else str(r.d) for r in df.select("x", S.parse_date_parts("x").alias("d")).collect()}
    assert got == want


def test_cell_parser_of_the_caller(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("30",)], "c string")
    got = [tuple(r.v) for r in df.coalesce(1).select(S.cell_parser(int, "bigint")(F.col("c")).alias("v")).collect()]
    assert got[0] == (1, None) and got[2] == (None, None) and got[3] == (30, None)
    assert got[1][0] is None and got[1][1].startswith("ValueError: invalid literal")
