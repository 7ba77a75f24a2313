"""Cleaning and failure-policy plans.

The reference parses names, ratings, heights, post codes and dates out of
small files.  Here the same parsers run as Column expressions over text that
Spark derives from the driver tables (so the work grows with the tables);
literal fixtures from the reference's specs are exercised in ``tests/``.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalar as S
from tessera.functions.numeric import fround
from tessera.operators import policies as P
from tessera.plans.common import spread, t
from tessera.plans.registry import plan


def _q(pattern: str) -> str:
    """A regex as a SQL string literal body."""
    return pattern.replace("'", "''")


@plan("acctbal_buckets", "SCL-01", sql="""
SELECT c_custkey, CASE WHEN c_acctbal BETWEEN -1000 AND -1 THEN 'negative' WHEN c_acctbal BETWEEN 0 AND 2500 THEN 'low'
                       WHEN c_acctbal BETWEEN 2501 AND 5000 THEN 'mid' WHEN c_acctbal BETWEEN 5001 AND 10000 THEN 'high'
                       ELSE 'other' END AS bucket FROM customer""")
def acctbal_buckets(spark, sf):
    # Closed integer ranges leave gaps (e.g. 2500.5); those rows are "other",
    # exactly as the reference's between-chain behaves.
    b = S.bucket_between("c_acctbal", [(-1000, -1, "negative"), (0, 2500, "low"), (2501, 5000, "mid"),
                                       (5001, 10000, "high")])
    return t(spark, sf, "customer").select("c_custkey", b.alias("bucket"))


@plan("segment_indicator", "SCL-02", sql="""
SELECT c_custkey, (CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::INTEGER AS is_building FROM customer""")
def segment_indicator(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", S.indicator(F.col("c_mktsegment") == "BUILDING").alias("is_building"))


@plan("part_size_class", "SCL-03", sql="""
SELECT p_partkey, (CASE WHEN s = 0 THEN 1 WHEN s BETWEEN 1 AND 3 THEN 2 ELSE 3 END)::INTEGER AS size_class
FROM (SELECT p_partkey, floor(p_size / 10)::BIGINT + (CASE WHEN p_retailprice >= 1500 THEN 1 ELSE 0 END) AS s FROM part)""")
def part_size_class(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", S.size_class(F.floor(F.col("p_size") / 10),
                                              S.indicator(F.col("p_retailprice") >= 1500)).alias("size_class"))


_PN = _q(S.PERSON_NAME)


@plan("part_name_parts", "SCL-04", sql=f"""
SELECT p_partkey,
       CASE WHEN regexp_matches(p_name, '{_PN}') THEN nullif(regexp_extract(p_name, '{_PN}', 1), '') END AS first,
       CASE WHEN regexp_matches(p_name, '{_PN}') THEN nullif(regexp_extract(p_name, '{_PN}', 3), '') END AS middle,
       CASE WHEN regexp_matches(p_name, '{_PN}') THEN nullif(regexp_extract(p_name, '{_PN}', 4), '') END AS last,
       CASE WHEN regexp_matches(p_name, '{_PN}') THEN nullif(regexp_extract(p_name, '{_PN}', 6), '') END AS suffix,
       CASE WHEN NOT regexp_matches(p_name, '{_PN}') THEN 'parse error in Name: ' || p_name END AS error
FROM part""")
def part_name_parts(spark, sf):
    return t(spark, sf, "part").select("p_partkey", S.parse_person_name("p_name").alias("n")).select("p_partkey", "n.*")


_CR = _q(S.CONTENT_RATING)
_RATING_TEXT = "p_type || '-' || p_size::VARCHAR"


def _ratings(spark, sf):
    p = t(spark, sf, "part")
    raw = F.concat(F.col("p_type"), F.lit("-"), F.col("p_size").cast("string"))
    return p.select("p_partkey", raw.alias("raw"), S.parse_content_rating(raw).alias("r")).select(
        "p_partkey", "raw", "r.*")


_RATING_SQL = f"""SELECT p_partkey, {_RATING_TEXT} AS raw,
       CASE WHEN regexp_matches({_RATING_TEXT}, '{_CR}') THEN regexp_extract({_RATING_TEXT}, '{_CR}', 1) END AS code,
       CASE WHEN regexp_matches({_RATING_TEXT}, '{_CR}') THEN nullif(regexp_extract({_RATING_TEXT}, '{_CR}', 3), '')::INTEGER END AS age,
       CASE WHEN NOT regexp_matches({_RATING_TEXT}, '{_CR}') THEN 'parse error in Rating: ' || {_RATING_TEXT} END AS error
FROM part"""


@plan("part_rating_codes", "SCL-05", sql=_RATING_SQL)
def part_rating_codes(spark, sf):
    return _ratings(spark, sf)


@plan("part_rating_ok", "ERR-02", sql=f"SELECT p_partkey, raw, code, age FROM ({_RATING_SQL}) WHERE error IS NULL")
def part_rating_ok(spark, sf):
    ok, _ = P.forgiving(_ratings(spark, sf))
    return ok


@plan("part_rating_quarantine", "ERR-02 ERR-05", sql=f"""
SELECT p_partkey, raw, error FROM ({_RATING_SQL}) WHERE error IS NOT NULL""")
def part_rating_quarantine(spark, sf):
    _, bad = P.forgiving(_ratings(spark, sf))
    return bad.select("p_partkey", "raw", "error")


@plan("part_rating_forgive_short_age", "ERR-03", sql=f"""
SELECT p_partkey, raw, code, age FROM ({_RATING_SQL}) WHERE error IS NULL""")
def part_rating_forgive_short_age(spark, sf):
    # Only a one-digit age is forgiven; any other failure would fail the job.
    return P.forgive_only(_ratings(spark, sf), F.col("raw").rlike(r"-\d$"))


_HEIGHT_TEXT = """CASE o_orderkey % 3 WHEN 0 THEN (4 + o_orderkey % 5)::VARCHAR || ' ft ' || (o_custkey % 12)::VARCHAR || ' in'
                     WHEN 1 THEN (4 + o_orderkey % 5)::VARCHAR || ''' ' || (o_custkey % 12)::VARCHAR || '"'
                     ELSE (4 + o_orderkey % 5)::VARCHAR || ' ft' END"""


def _height_text():
    feet = (4 + F.col("o_orderkey") % 5).cast("string")
    inch = (F.col("o_custkey") % 12).cast("string")
    k = F.col("o_orderkey") % 3
    return (F.when(k == 0, F.concat(feet, F.lit(" ft "), inch, F.lit(" in")))
            .when(k == 1, F.concat(feet, F.lit("' "), inch, F.lit('"')))
            .otherwise(F.concat(feet, F.lit(" ft"))))


@plan("order_heights", "SCL-07", sql=f"""
WITH h AS (SELECT o_orderkey, {_HEIGHT_TEXT} AS height FROM orders),
p AS (SELECT o_orderkey, height, (4 + o_orderkey % 5)::INTEGER AS feet,
             (CASE WHEN o_orderkey % 3 = 2 THEN 0 ELSE o_custkey % 12 END)::INTEGER AS inches FROM h JOIN orders USING (o_orderkey))
SELECT o_orderkey, height, feet, inches, feet * 12 + inches AS total_inches,
       CASE feet WHEN 8 THEN 'giant' WHEN 7 THEN 'very tall' WHEN 6 THEN 'tall' WHEN 5 THEN 'normal' ELSE 'short' END AS class,
       NULL::VARCHAR AS error
FROM p""")
def order_heights(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", _height_text().alias("height"))
    return o.select("o_orderkey", "height", S.parse_height("height").alias("h")).select("o_orderkey", "height", "h.*")


@plan("order_height_pairs", "ERR-06", sql=f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL
                        ELSE to_json({{'feet': (4 + o_orderkey % 5)::INTEGER, 'inches': (o_custkey % 12)::INTEGER}})::VARCHAR END
                   AS feet_inches
FROM orders""")
def order_height_pairs(spark, sf):
    # Both parts present -> a pair; a feet-only height has no explicit inches -> null.
    o = t(spark, sf, "orders").select("o_orderkey", _height_text().alias("h"))
    feet = S.group("h", S.HEIGHT_FT_IN, 1).cast("int")
    inches = S.group("h", S.HEIGHT_FT_IN, 3).cast("int")
    pair = P.all_or_nothing({"feet": feet, "inches": inches})
    return o.select("o_orderkey", F.to_json(pair).alias("feet_inches"))


_SSN_TEXT = """lpad((c_custkey % 1000)::VARCHAR, 3, '0') || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '-' END
               || lpad((c_nationkey % 100)::VARCHAR, 2, '0') || '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0')"""


@plan("customer_ssn_parts", "SCL-08", sql=f"""
WITH s AS (SELECT c_custkey, c_nationkey, {_SSN_TEXT} AS ssn FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 1000)::INTEGER END AS area,
       CASE WHEN c_custkey % 7 <> 0 THEN (c_nationkey % 100)::INTEGER END AS grp,
       CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 10000)::INTEGER END AS serial,
       CASE WHEN c_custkey % 7 = 0 THEN 'bad ssn: ' || ssn END AS error
FROM s""")
def customer_ssn_parts(spark, sf):
    c = t(spark, sf, "customer")
    ssn = F.concat(F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"),
                   F.when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(F.lit("-")),
                   F.lpad((F.col("c_nationkey") % 100).cast("string"), 2, "0"), F.lit("-"),
                   F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"))
    return c.select("c_custkey", S.parse_ssn(ssn).alias("s")).select("c_custkey", "s.*")


@plan("order_dmy_dates", "SCL-08", sql="""
SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day,
       NULL::VARCHAR AS error FROM orders""")
def order_dmy_dates(spark, sf):
    o = t(spark, sf, "orders")
    text = F.concat_ws("/", F.dayofmonth("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"),
                       F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", S.parse_dmy(text).alias("d")).select("o_orderkey", "d.*")


@plan("part_simple_names", "SCL-08", sql=r"""
SELECT p_partkey, regexp_extract(p_name, '^(\w+)\s+(\w+)$', 1) AS first, NULL::VARCHAR AS middle,
       regexp_extract(p_name, '^(\w+)\s+(\w+)$', 2) AS last, NULL::VARCHAR AS error FROM part""")
def part_simple_names(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", S.parse_simple_name("p_name").alias("n")).select("p_partkey", "n.*")


def _position_lines(spark, sf, always_decimal: bool):
    li = t(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_linenumber")
    q = F.col("l_quantity").cast("string")
    if not always_decimal:
        # First lines print the quantity without a decimal point: rejected.
        q = F.when(F.col("l_linenumber") == 1, F.col("l_quantity").cast("int").cast("string")).otherwise(q)
    raw = F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" "), q)
    return li.select(raw.alias("raw"), S.parse_position(raw).alias("p")).select("raw", "p.*")


_POS_TEXT = "'P' || l_partkey::VARCHAR || ' ' || CASE WHEN l_linenumber = 1 THEN l_quantity::INTEGER::VARCHAR ELSE l_quantity::VARCHAR END"


@plan("line_positions_ok", "SCL-09 ERR-02", sql="""
SELECT 'P' || l_partkey::VARCHAR AS symbol, l_quantity AS quantity FROM lineitem WHERE l_linenumber <> 1""")
def line_positions_ok(spark, sf):
    ok, _ = P.forgiving(_position_lines(spark, sf, False))
    return ok.select("symbol", "quantity")


@plan("line_positions_quarantine", "SCL-09 ERR-05", sql=f"""
SELECT {_POS_TEXT} AS raw, 'cannot parse ' || {_POS_TEXT} || ' as a Position' AS error FROM lineitem WHERE l_linenumber = 1""")
def line_positions_quarantine(spark, sf):
    _, bad = P.forgiving(_position_lines(spark, sf, False))
    return bad.select("raw", "error")


@plan("line_positions_strict", "ERR-01", sql="""
SELECT 'P' || l_partkey::VARCHAR AS symbol, l_quantity AS quantity FROM lineitem""")
def line_positions_strict(spark, sf):
    return P.strict(_position_lines(spark, sf, True)).select("symbol", "quantity")


_PC_TEXT = """chr((65 + c_nationkey % 26)::INTEGER) || CASE WHEN c_custkey % 2 = 0 THEN chr((65 + c_custkey % 26)::INTEGER) ELSE '' END
  || (c_custkey % 10)::VARCHAR || CASE WHEN c_custkey % 3 = 0 THEN ((c_custkey // 10) % 10)::VARCHAR ELSE '' END
  || CASE WHEN c_custkey % 5 = 0 THEN 'A' ELSE '' END || ' ' || (c_custkey % 9)::VARCHAR
  || chr((65 + (c_custkey // 7) % 26)::INTEGER) || CASE WHEN c_custkey % 13 = 0 THEN 'x' ELSE chr((65 + (c_custkey // 11) % 26)::INTEGER) END"""
_PC = _q(S.POSTCODE)


def _postcode_text():
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    ch = lambda e: F.char(e.cast("int"))
    return F.concat(ch(65 + n % 26), F.when(k % 2 == 0, ch(65 + k % 26)).otherwise(F.lit("")),
                    (k % 10).cast("string"),
                    F.when(k % 3 == 0, (F.floor(k / 10) % 10).cast("string")).otherwise(F.lit("")),
                    F.when(k % 5 == 0, F.lit("A")).otherwise(F.lit("")), F.lit(" "), (k % 9).cast("string"),
                    ch(65 + F.floor(k / 7) % 26),
                    F.when(k % 13 == 0, F.lit("x")).otherwise(ch(65 + F.floor(k / 11) % 26)))


@plan("customer_postcodes", "SCL-10", sql=f"""
WITH p AS (SELECT c_custkey, {_PC_TEXT} AS pc FROM customer)
SELECT c_custkey, pc,
  CASE WHEN regexp_matches(pc, '{_PC}') THEN regexp_extract(pc, '{_PC}', 1) END AS area,
  CASE WHEN regexp_matches(pc, '{_PC}') THEN regexp_extract(pc, '{_PC}', 2) || regexp_extract(pc, '{_PC}', 3)
                                            || regexp_extract(pc, '{_PC}', 4) END AS district,
  CASE WHEN regexp_matches(pc, '{_PC}') THEN regexp_extract(pc, '{_PC}', 5)::INTEGER END AS sector,
  CASE WHEN regexp_matches(pc, '{_PC}') THEN regexp_extract(pc, '{_PC}', 6) END AS unit,
  CASE WHEN NOT regexp_matches(pc, '{_PC}') THEN 'bad post code: ' || pc END AS error
FROM p""")
def customer_postcodes(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", _postcode_text().alias("pc"))
    return c.select("c_custkey", "pc", S.parse_postcode("pc").alias("p")).select("c_custkey", "pc", "p.*")


@plan("event_minutes", "SCL-11", sql="""
SELECT event_id, (hour(ts) * 100 + minute(ts))::INTEGER AS hhmm, (hour(ts) * 60 + minute(ts))::INTEGER AS minutes FROM events""")
def event_minutes(spark, sf):
    e = t(spark, sf, "events").select("event_id", (F.hour("ts") * 100 + F.minute("ts")).alias("hhmm"))
    return e.select("event_id", "hhmm", S.hhmm_minutes("hhmm").alias("minutes"))


@plan("segment_gender_codes", "SCL-12", sql="""
SELECT c_custkey, CASE substr(c_mktsegment, 1, 1) WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' ELSE 'unknown' END AS gender
FROM customer""")
def segment_gender_codes(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", S.gender(F.substring("c_mktsegment", 1, 1)).alias("gender"))


@plan("event_temperatures", "SCL-13", sql="""
WITH s AS (SELECT event_id, CASE WHEN event_type = 'error' THEN value::VARCHAR || 'x' ELSE value::VARCHAR END AS reading FROM events)
SELECT event_id, reading, round((TRY_CAST(reading AS DOUBLE) - 32) * 5 / 9, 4) AS celsius,
       CASE WHEN TRY_CAST(reading AS DOUBLE) IS NULL THEN 'invalid input' END AS error FROM s""")
def event_temperatures(spark, sf):
    e = t(spark, sf, "events")
    reading = F.when(F.col("event_type") == "error", F.concat(F.col("value").cast("string"), F.lit("x"))).otherwise(
        F.col("value").cast("string"))
    c = e.select("event_id", reading.alias("reading")).withColumn("c", S.convert_temperature("reading", "C"))
    return c.select("event_id", "reading", fround("c.value", 4).alias("celsius"), F.col("c.error").alias("error"))


_CELL_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _cell_sql():
    def typ(x):
        return (f"CASE WHEN regexp_matches({x}, '{_q(S.CELL_DATE)}') THEN 'datetime' "
                f"WHEN regexp_matches({x}, '{_q(S.CELL_QUOTED)}') THEN 'string' "
                f"WHEN regexp_matches({x}, '{_q(S.CELL_WHOLE)}') THEN 'int' "
                f"WHEN regexp_matches({x}, '{_q(S.CELL_TRUE)}') THEN 'boolean' "
                f"WHEN regexp_matches({x}, '{_q(S.CELL_FALSE)}') THEN 'boolean' "
                f"WHEN regexp_matches({x}, '{_q(S.CELL_FLOAT)}') THEN 'double' ELSE 'string' END")
    parts = [f"SELECT '{c}' AS column_name, {c}::VARCHAR AS cell FROM orders" for c in _CELL_COLS]
    return f"""SELECT column_name, {typ('cell')} AS cell_type, count(*) AS n
FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2"""


@plan("order_cell_type_profile", "SCL-14 UDF-02", sql=_cell_sql())
def order_cell_type_profile(spark, sf):
    o = t(spark, sf, "orders")
    stacked = o.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("cell"))
                                           for c in _CELL_COLS])).alias("x")).select("x.*")
    return stacked.groupBy("column_name", S.cell_type("cell").alias("cell_type")).agg(F.count(F.lit(1)).alias("n"))


# The date layouts written, and the parse order (US first).
DATE_WRITE = ["yyyy-MM-dd", "MM/dd/yy", "dd MMM yyyy", "MMMM d, yyyy"]
DATE_PARSE = ["yyyy-MM-dd", "MM/dd/yy", "dd/MM/yy", "dd MMM yyyy", "MMMM d, yyyy"]


@plan("order_date_formats", "SCL-15 ERR-07", sql="""
SELECT o_orderkey,
       CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%y')
                           WHEN 2 THEN strftime(o_orderdate, '%d %b %Y') ELSE strftime(o_orderdate, '%B %-d, %Y') END AS text,
       CASE o_orderkey % 4 WHEN 1 THEN make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate))
                           ELSE o_orderdate::DATE END AS parsed
FROM orders""")
def order_date_formats(spark, sf):
    # Parsing several layouts is CPU-heavy per row: use every core.
    o = spread(t(spark, sf, "orders").select("o_orderkey", "o_orderdate"))
    k = F.col("o_orderkey") % 4
    text = F.date_format("o_orderdate", DATE_WRITE[0])
    for i, fmt in enumerate(DATE_WRITE[1:], start=1):
        text = F.when(k == i, F.date_format("o_orderdate", fmt)).otherwise(text)
    w = o.select("o_orderkey", text.alias("text"))
    return w.select("o_orderkey", "text", P.first_success(S.parse_date_any("text", DATE_PARSE)).cast("date").alias("parsed"))


_PARTS_SQL = ["'%Y-%m-%d'", "'%Y-%b-%d'", "'%d-%b-%Y'", "'%m-%d-%Y'", "'%m/%d/%Y'", "'%b-%d-%Y'", "'%m/%d/%y'"]
_PARTS = ["yyyy-MM-dd", "yyyy-MMM-dd", "dd-MMM-yyyy", "MM-dd-yyyy", "MM/dd/yyyy", "MMM-dd-yyyy", "MM/dd/yy"]


@plan("order_dashed_dates", "SCL-15", sql=f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN lower(text) ELSE upper(text) END AS text, CASE WHEN o_orderkey % 7 = 6
       THEN make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate)) ELSE o_orderdate::DATE END AS parsed
FROM (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 7 {' '.join(
    f"WHEN {i} THEN strftime(o_orderdate, {f})" for i, f in enumerate(_PARTS_SQL))} END AS text FROM orders)""")
def order_dashed_dates(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    text = F.lit(None).cast("string")
    for i, layout in enumerate(_PARTS):
        text = F.when(F.col("o_orderkey") % 7 == i, F.date_format("o_orderdate", layout)).otherwise(text)
    text = F.when(F.col("o_orderkey") % 2 == 0, F.lower(text)).otherwise(F.upper(text))
    w = o.select("o_orderkey", text.alias("text"))
    return w.select("o_orderkey", "text", S.parse_date_parts("text").alias("parsed"))


def _priority_rank(cell: str) -> int:
    rank, name = cell.split("-", 1)
    if name == "LOW":
        raise ValueError(f"no rank for {name}")
    return int(rank)


@plan("order_priority_cells", "UDF-02", sql="""
SELECT o_orderkey, CASE WHEN o_orderpriority NOT LIKE '%LOW' THEN split_part(o_orderpriority, '-', 1)::BIGINT END AS value,
       CASE WHEN o_orderpriority LIKE '%LOW' THEN 'ValueError: no rank for LOW' END AS error FROM orders""")
def order_priority_cells(spark, sf):
    # The parser is the caller's own function.
    cell = S.cell_parser(_priority_rank, "bigint")(F.col("o_orderpriority"))
    return t(spark, sf, "orders").select("o_orderkey", cell.alias("c")).select("o_orderkey", "c.value", "c.error")


@plan("document_substring_flags", "SCL-18", sql="""
SELECT doc_id, contains(text, 'the') AS has_the, contains(text, '') AS has_empty FROM documents""")
def document_substring_flags(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", S.contains("text", "the").alias("has_the"), S.contains("text", "").alias("has_empty"))


@plan("event_props_paths", "SCL-19 SRC-12", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k,
       CASE WHEN json_type(props, '$') IN ('OBJECT', 'ARRAY') THEN NULL ELSE json_extract_string(props, '$') END AS root
FROM events""")
def event_props_paths(spark, sf):
    e = t(spark, sf, "events")
    return e.select("event_id", S.json_path("props", "$.k").alias("k"), S.json_path("props", "$").alias("root"))


@plan("customer_display_text", "SCL-21", sql="""
SELECT c_custkey, concat_ws(' ', c_name, '(' || floor(c_acctbal)::BIGINT::VARCHAR || ' likes)') AS display FROM customer""")
def customer_display_text(spark, sf):
    c = t(spark, sf, "customer")
    likes = F.concat(F.lit("("), F.floor("c_acctbal").cast("string"), F.lit(" likes)"))
    return c.select("c_custkey", F.concat_ws(" ", "c_name", likes).alias("display"))


@plan("order_french_dates", "SCL-22", sql="""
SELECT o_orderkey, day(o_orderdate)::VARCHAR || ' ' ||
       ['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre'][month(o_orderdate)]
       || ' ' || year(o_orderdate)::VARCHAR AS french FROM orders""")
def order_french_dates(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", S.french_long_date("o_orderdate").alias("french"))


@plan("page_hosts", "SCL-23", sql="""
SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1) AS host FROM pages""")
def page_hosts(spark, sf):
    from tessera.functions.text import url_host
    return t(spark, sf, "pages").select("page_id", url_host("url").alias("host"))


@plan("order_row_equality", "SCL-24", sql="""
SELECT o_orderkey, o_totalprice = round(o_totalprice) AS same FROM orders""")
def order_row_equality(spark, sf):
    o = t(spark, sf, "orders")
    one = F.struct(*[F.col(c).alias(c) for c in o.columns])
    two = F.struct(*[(fround("o_totalprice", 0) if c == "o_totalprice" else F.col(c)).alias(c) for c in o.columns])
    return o.select("o_orderkey", one.eqNullSafe(two).alias("same"))


@plan("order_row_hash", "SCL-24", sql="""
SELECT o_orderkey, md5(concat_ws('|', coalesce(o_orderkey::VARCHAR, ''), coalesce(o_custkey::VARCHAR, ''),
  coalesce(o_orderstatus, ''), coalesce(round(o_totalprice * 100)::BIGINT::VARCHAR, ''),
  coalesce(strftime(o_orderdate, '%Y-%m-%d'), ''), coalesce(o_orderpriority, ''))) AS row_hash FROM orders""")
def order_row_hash(spark, sf):
    # A stable fingerprint of the row's fields as text (cents for the price).
    text = {"o_totalprice": fround(F.col("o_totalprice") * 100, 0).cast("bigint").cast("string"),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd")}
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    parts = [F.coalesce(text.get(c, F.col(c).cast("string")), F.lit("")) for c in cols]
    return t(spark, sf, "orders").select("o_orderkey", F.md5(F.concat_ws("|", *parts)).alias("row_hash"))


@plan("order_price_expectation", "SCL-25", sql="""
SELECT o_orderkey, CASE WHEN o_totalprice > 50000 THEN o_totalprice END AS value,
       CASE WHEN NOT (o_totalprice > 50000) THEN 'expected a price above 50000 for order ' || o_orderkey::VARCHAR END AS error
FROM orders""")
def order_price_expectation(spark, sf):
    o = t(spark, sf, "orders")
    msg = F.concat(F.lit("expected a price above 50000 for order "), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", S.expect("o_totalprice", F.col("o_totalprice") > 50000, msg).alias("x")).select(
        "o_orderkey", "x.*")


def _user_readings(spark, sf):
    e = t(spark, sf, "events")
    raw = F.when((F.col("event_type") == "error") & (F.col("event_id") % 4 == 0), F.lit("n/a")).otherwise(
        F.col("value").cast("string"))
    x = raw.try_cast("double")
    return e.select("user_id", x.alias("v"), F.when(x.isNull(), F.concat(F.lit("bad value: "), raw)).alias("error"))


_USER_SQL = """WITH r AS (SELECT user_id, CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'n/a' ELSE value::VARCHAR END AS raw
                 FROM events),
g AS (SELECT user_id, count(*) FILTER (WHERE TRY_CAST(raw AS DOUBLE) IS NULL) AS n_errors,
             round(sum(TRY_CAST(raw AS DOUBLE)), 4) AS value
      FROM r GROUP BY user_id)"""


@plan("user_value_ok", "ERR-04 AGG-21", sql=f"{_USER_SQL} SELECT user_id, value FROM g WHERE n_errors = 0")
def user_value_ok(spark, sf):
    ok, _ = P.per_key_outcome(_user_readings(spark, sf), "user_id", fround(F.sum("v"), 4))
    return ok


@plan("user_value_errors", "ERR-04 ERR-05", sql="""
WITH r AS (SELECT user_id, CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'n/a' ELSE value::VARCHAR END AS raw
           FROM events)
SELECT user_id, 'bad value: ' || raw AS message, count(*) AS n FROM r WHERE TRY_CAST(raw AS DOUBLE) IS NULL
GROUP BY user_id, raw""")
def user_value_errors(spark, sf):
    _, errors = P.per_key_outcome(_user_readings(spark, sf), "user_id", fround(F.sum("v"), 4))
    return errors


@plan("event_type_strict_mean_k", "AGG-30 ERR-01", sql="""
SELECT event_type, round(avg(json_extract_string(props, '$.k')::INTEGER), 6) AS mean_k
FROM events WHERE json_extract_string(props, '$.k') <> '' GROUP BY event_type""")
def event_type_strict_mean_k(spark, sf):
    # Non-empty cells must all parse; one bad cell fails the whole job.
    e = t(spark, sf, "events").select("event_type", F.get_json_object("props", "$.k").alias("k")).where("k <> ''")
    typed = e.select("event_type", F.col("k").try_cast("int").alias("ki"),
                     F.when(F.col("k").try_cast("int").isNull(), F.concat(F.lit("not a number: "), "k")).alias("error"))
    return P.strict(typed).groupBy("event_type").agg(fround(F.avg("ki"), 6).alias("mean_k"))


_RT_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.StringType())])


@plan("order_json_roundtrip", "SNK-05 SRC-12", sql="SELECT count(*) AS n, true AS all_equal FROM orders")
def order_json_roundtrip(spark, sf):
    o = t(spark, sf, "orders").select(F.struct(*[f.name for f in _RT_SCHEMA.fields]).alias("r"))
    back = F.from_json(F.to_json("r"), _RT_SCHEMA)
    return o.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_and(back.eqNullSafe(F.col("r"))), F.lit(True)).alias("all_equal"))


_PRIORITY = r"^(\d)-(.+)$"


@plan("order_typed_records", "SCL-06 PRJ-06", sql=r"""
SELECT o_orderkey, o_orderstatus = 'F' AS finished, TRY_CAST(regexp_extract(o_orderpriority, '^(\d)-(.+)$', 1) AS INTEGER) AS level,
       nullif(regexp_extract(o_orderpriority, '^(\d)-(.+)$', 2), '') AS level_name, o_totalprice AS price,
       year(o_orderdate)::INTEGER AS year
FROM orders""")
def order_typed_records(spark, sf):
    # Every field arrives as text (as from an all-string CSV) and is typed by
    # try_cast / comparisons / regex groups on the executors.
    o = t(spark, sf, "orders").select(*[F.col(c).cast("string").alias(c) for c in
                                        ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"]])
    return o.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                    (F.col("o_orderstatus") == "F").alias("finished"),
                    S.group("o_orderpriority", _PRIORITY, 1).try_cast("int").alias("level"),
                    S.group("o_orderpriority", _PRIORITY, 2).alias("level_name"),
                    F.col("o_totalprice").try_cast("double").alias("price"),
                    F.year(F.col("o_orderdate").try_cast("timestamp")).alias("year"))
