"""Scalar cleaning functions.

Every parser is a native Column expression that returns a struct of typed
fields plus ``error`` (null when the input parsed).  Nothing here runs
Python per row; failures are data, and the policies in
:mod:`tessera.operators.policies` decide whether they drop, fail or report.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the reference uses for its record parsers.
PERSON_NAME = r"^([\p{L}\-']+\.?)\s*(([\p{L}\-]+\.)\s)?([\p{L}\-']+\.?)(\s([\p{L}\-]+\.?))?$"
CONTENT_RATING = r"^(\w*)(-(\d\d))?$"
HEIGHT_FT = r"^\s*(\d+)\s*(?:ft|')$"
HEIGHT_FT_IN = r"^\s*(\d+)\s*(?:ft|')(\s*(\d+)\s*(?:in|\"))?\s*$"
SIMPLE_NAME_1 = r"^(\w+)$"
SIMPLE_NAME_2 = r"^(\w+)\s+(\w+)$"
SIMPLE_NAME_3 = r"^(\w+)\s+(\w.*)\s+(\w+)$"
SSN = r"^(\d{3})\-(\d{2})\-(\d{4})$"
DMY_DATE = r"^(\d+)/(\d+)/(\d+)$"
POSITION = r"^(\w+)\s+(\d+(\.\d+))$"
# UK post code: area (1-2 letters), district (digit, optional digit, optional
# letter), a blank, sector digit and a two-letter unit.  The reference's
# digit check wrongly rejects 9; this pattern accepts every digit.
POSTCODE = r"^([A-Z]{1,2})(\d)(\d)?([A-Z])? (\d)([A-Z]{2})$"
# Cell typing (SCL-14), tried in this order.
CELL_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
CELL_QUOTED = r'^"([^"]*)"$'
CELL_WHOLE = r"^\d+$"
CELL_TRUE = r"(?i)^([ty]|true|yes)$"
CELL_FALSE = r"(?i)^([fn]|false|no)$"
CELL_FLOAT = r"^-?(\d+(\.\d*)?|\d*\.\d+)([eE][+-]?\d+)?[fFdD]?$"
# Height classes by whole feet.
HEIGHT_CLASSES = [(8, "giant"), (7, "very tall"), (6, "tall"), (5, "normal")]
# French month names for the long-form French date.
FRENCH_MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
                 "septembre", "octobre", "novembre", "décembre"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def group(col, pattern: str, idx: int) -> Column:
    """Regex group as a string, null (not ``''``) when it did not take part."""
    return F.nullif(F.regexp_extract(_c(col), pattern, idx), F.lit(""))


def _err(ok: Column, message: Column) -> Column:
    return F.when(~ok | ok.isNull(), message)


# ---------------------------------------------------------- Spark-side CASE --


def bucket_between(col, buckets: Sequence[tuple[float, float, str]], other: str = "other") -> Column:
    """CASE of closed ``between`` ranges; gaps and null fall to ``other``
    (SCL-01; values in the gaps between ranges also land there)."""
    c = _c(col)
    e = None
    for lo, hi, label in buckets:
        cond = c.between(lo, hi)
        e = F.when(cond, F.lit(label)) if e is None else e.when(cond, F.lit(label))
    return e.otherwise(F.lit(other))


def indicator(cond: Column) -> Column:
    """1 where ``cond`` holds, else 0 (null counts as 0) (SCL-02)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def size_class(a, b) -> Column:
    """Class from the sum of two counts: 0 -> 1, 1..3 -> 2, else 3 (SCL-03)."""
    s = _c(a) + _c(b)
    return F.when(s == 0, 1).when(s.between(1, 3), 2).otherwise(3)


# ----------------------------------------------------------------- parsers --


def parse_person_name(col) -> Column:
    """first, middle?, last, suffix? of a person's name (SCL-04)."""
    c = _c(col)
    ok = c.rlike(PERSON_NAME)
    part = lambda i: F.when(ok, group(c, PERSON_NAME, i))
    return F.struct(part(1).alias("first"), part(3).alias("middle"), part(4).alias("last"),
                    part(6).alias("suffix"),
                    _err(ok, F.concat(F.lit("parse error in Name: "), c)).alias("error"))


def parse_content_rating(col) -> Column:
    """``CODE[-NN]`` -> code, age? (SCL-05)."""
    c = _c(col)
    ok = c.rlike(CONTENT_RATING)
    return F.struct(F.when(ok, F.regexp_extract(c, CONTENT_RATING, 1)).alias("code"),
                    F.when(ok, group(c, CONTENT_RATING, 3).cast("int")).alias("age"),
                    _err(ok, F.concat(F.lit("parse error in Rating: "), c)).alias("error"))


def parse_height(col) -> Column:
    """``6 ft 5 in`` / ``6' 5"`` / ``6 ft`` -> feet, inches, total inches and
    class (SCL-07)."""
    c = _c(col)
    ft_only = c.rlike(HEIGHT_FT)
    ft_in = c.rlike(HEIGHT_FT_IN)
    feet = F.when(ft_only, group(c, HEIGHT_FT, 1)).when(ft_in, group(c, HEIGHT_FT_IN, 1)).cast("int")
    inches = F.when(ft_only, F.lit(0)).when(ft_in, F.coalesce(group(c, HEIGHT_FT_IN, 3).cast("int"), F.lit(0)))
    klass = None
    for ft, name in HEIGHT_CLASSES:
        klass = F.when(feet == ft, name) if klass is None else klass.when(feet == ft, name)
    klass = klass.when(feet.isNotNull(), "short")
    return F.struct(feet.alias("feet"), inches.alias("inches"), (feet * 12 + inches).alias("total_inches"),
                    klass.alias("class"),
                    _err(ft_only | ft_in, F.concat(F.lit("bad height: "), c)).alias("error"))


def parse_simple_name(col) -> Column:
    """One, two or three-plus words -> (first?, middle?, last) (SCL-08)."""
    c = _c(col)
    one, two, three = c.rlike(SIMPLE_NAME_1), c.rlike(SIMPLE_NAME_2), c.rlike(SIMPLE_NAME_3)
    first = F.when(two, group(c, SIMPLE_NAME_2, 1)).when(three, group(c, SIMPLE_NAME_3, 1))
    middle = F.when(~two & three, group(c, SIMPLE_NAME_3, 2))
    last = (F.when(one, group(c, SIMPLE_NAME_1, 1)).when(two, group(c, SIMPLE_NAME_2, 2))
            .when(three, group(c, SIMPLE_NAME_3, 3)))
    return F.struct(first.alias("first"), middle.alias("middle"), last.alias("last"),
                    _err(one | two | three, F.concat(F.lit("bad name: "), c)).alias("error"))


def parse_ssn(col) -> Column:
    """``ddd-dd-dddd`` -> area, group, serial (SCL-08)."""
    c = _c(col)
    ok = c.rlike(SSN)
    return F.struct(*[F.when(ok, group(c, SSN, i).cast("int")).alias(n) for i, n in
                      [(1, "area"), (2, "grp"), (3, "serial")]],
                    _err(ok, F.concat(F.lit("bad ssn: "), c)).alias("error"))


def parse_dmy(col) -> Column:
    """``d/m/y`` -> year, month, day (SCL-08)."""
    c = _c(col)
    ok = c.rlike(DMY_DATE)
    return F.struct(F.when(ok, group(c, DMY_DATE, 3).cast("int")).alias("year"),
                    F.when(ok, group(c, DMY_DATE, 2).cast("int")).alias("month"),
                    F.when(ok, group(c, DMY_DATE, 1).cast("int")).alias("day"),
                    _err(ok, F.concat(F.lit("bad date: "), c)).alias("error"))


def parse_position(col) -> Column:
    """``SYMBOL quantity`` with a required decimal point (SCL-09).  The
    symbol group is mandatory, so a non-empty group 1 is the match test and
    the line costs two regex passes, not three."""
    c = _c(col)
    sym = F.regexp_extract(c, POSITION, 1)
    ok = sym != ""
    return F.struct(F.when(ok, sym).alias("symbol"),
                    F.when(ok, F.regexp_extract(c, POSITION, 2).cast("double")).alias("quantity"),
                    _err(ok, F.concat(F.lit("cannot parse "), c, F.lit(" as a Position"))).alias("error"))


def parse_postcode(col) -> Column:
    """UK post code -> area, district, sector, unit (SCL-10)."""
    c = _c(col)
    ok = c.rlike(POSTCODE)
    district = F.concat(group(c, POSTCODE, 2), F.coalesce(group(c, POSTCODE, 3), F.lit("")),
                        F.coalesce(group(c, POSTCODE, 4), F.lit("")))
    return F.struct(F.when(ok, group(c, POSTCODE, 1)).alias("area"), F.when(ok, district).alias("district"),
                    F.when(ok, group(c, POSTCODE, 5).cast("int")).alias("sector"),
                    F.when(ok, group(c, POSTCODE, 6)).alias("unit"),
                    _err(ok, F.concat(F.lit("bad post code: "), c)).alias("error"))


def hhmm_minutes(col) -> Column:
    """``HHMM`` integer -> minutes since midnight (SCL-11)."""
    c = _c(col)
    return (F.floor(c / 100) * 60 + c % 100).cast("int")


def gender(col) -> Column:
    """``M`` / ``F`` / anything else -> male / female / unknown (SCL-12)."""
    c = _c(col)
    return F.when(c == "M", "male").when(c == "F", "female").otherwise("unknown")


def convert_temperature(col, to: str = "C") -> Column:
    """Guarded unit conversion of a numeric string (SCL-13): value, unit and
    ``invalid input`` as the error when the text is not a number."""
    x = F.col(col).try_cast("double") if isinstance(col, str) else col.try_cast("double")
    v = (x - 32) * 5 / 9 if to == "C" else x * 9 / 5 + 32
    return F.struct(v.alias("value"), F.lit(to).alias("unit"),
                    F.when(x.isNull(), F.lit("invalid input")).alias("error"))


def cell_type(col) -> Column:
    """Type name of a text cell, tried in the reference's order (SCL-14)."""
    c = _c(col)
    return (F.when(c.rlike(CELL_DATE), "datetime").when(c.rlike(CELL_QUOTED), "string")
            .when(c.rlike(CELL_WHOLE), "int").when(c.rlike(CELL_TRUE), "boolean")
            .when(c.rlike(CELL_FALSE), "boolean").when(c.rlike(CELL_FLOAT), "double")
            .otherwise("string"))


def datetime_shape(fmt: str) -> str | None:
    """A regex matching the text shape of a datetime pattern (``MM/dd/yy`` ->
    ``^\\d{2}/\\d{2}/\\d{2}$``), or None for pattern letters it does not know."""
    import re

    out, i = [], 0
    while i < len(fmt):
        ch, j = fmt[i], i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        n = j - i
        if ch == "'":
            k = fmt.index("'", i + 1)
            out.append(re.escape(fmt[i + 1:k]))
            i = k + 1
            continue
        if ch == "y":
            out.append(r"\d{2}" if n == 2 else r"\d{4}")
        elif ch == "M":
            out.append({1: r"\d{1,2}", 2: r"\d{2}", 3: "[A-Za-z]{3}"}.get(n, "[A-Za-z]+"))
        elif ch in "dHhms":
            out.append(r"\d{1,2}" if n == 1 else r"\d{2}")
        elif ch == "S":
            out.append(r"\d+")
        elif ch.isalpha():
            return None
        else:
            out.append(re.escape(ch * n))
        i = j
    return "^" + "".join(out) + "$"


def parse_date_any(col, formats: Sequence[str]) -> Column:
    """First format that parses wins (SCL-15, ERR-07): ``coalesce`` of
    ``try_to_timestamp`` per format; null when none does.  Each attempt is
    guarded by a regex of the format's shape, so rows only pay for the
    format they look like instead of a failed parse per earlier format."""
    c = _c(col)
    tries = []
    for f in formats:
        shape = datetime_shape(f)
        attempt = F.try_to_timestamp(c, F.lit(f))
        tries.append(F.when(c.rlike(shape), attempt) if shape else attempt)
    return F.coalesce(*tries)


# Month names, and the layouts in the order they are tried (US,
# traditional British, ISO), with "-" or "/" between.
MONTH_NAMES = "janfebmaraprmayjunjulaugsepoctnovdec"
DATE_LAYOUTS = ("mdy", "dmy", "ymd")


def parse_date_parts(col) -> Column:
    """Date of a text whose month is a number or a three-letter name in any
    case and whose year has four digits or two (20xx): ``09/30/2015``,
    ``sep-30-2015``, ``30-sep-2015``, ``2015-SEP-30`` (SCL-15).  The first
    layout that gives a date wins, so an all-digit date is American unless it
    cannot be; null when none does."""
    c = F.lower(_c(col))
    shape = {"y": "([0-9]{4}|[0-9]{2})", "m": "([a-z]{3}|[0-9]{1,2})", "d": "([0-9]{1,2})"}
    tries = []
    for layout in DATE_LAYOUTS:
        pattern = "^" + "[-/]".join(shape[x] for x in layout) + "$"
        y, m, d = (F.regexp_extract(c, pattern, layout.index(x) + 1) for x in "ymd")
        place = F.instr(F.lit(MONTH_NAMES), m)
        named = F.when(place % 3 == 1, F.floor((place + 2) / 3).cast("string"))
        month = F.when(m.rlike("^[0-9]+$"), m).otherwise(named)
        year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
        tries.append(F.when(c.rlike(pattern), F.try_to_timestamp(F.concat_ws("-", year, month, d), F.lit("y-M-d"))))
    return F.coalesce(*tries).cast("date")


def cell_parser(parse, kind: str):
    """The caller's parser of a text cell as a column function (UDF-02):
    ``parse`` takes a string and returns a value of the Spark type ``kind`` or
    raises; the result is a struct of ``value`` and ``error``, one of them
    null.  A null cell has neither.  Arrow batches, one call a cell."""
    @F.pandas_udf(f"struct<value:{kind},error:string>")
    def parsed(cells: pd.Series) -> pd.DataFrame:
        values, errors = [], []
        for x in cells:
            value = error = None
            if x is not None:
                try:
                    value = parse(x)
                except Exception as e:  # noqa: BLE001 - whatever the caller's parser raises is the cell's error
                    error = f"{type(e).__name__}: {e}"
            values.append(value)
            errors.append(error)
        return pd.DataFrame({"value": pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)})

    return parsed


def contains(col, pattern: str) -> Column:
    """Substring test; an empty pattern is contained in every string (SCL-18)."""
    return F.contains(_c(col), F.lit(pattern))


def json_path(col, path: str) -> Column:
    """Leaf value at a JSON path (SCL-19); a path that ends on an object or
    array (a branch) gives null, not the branch's JSON text."""
    v = F.get_json_object(_c(col), path)
    return F.when(~(v.startswith("{") | v.startswith("[")), v)


def french_long_date(col) -> Column:
    """Long French date, e.g. ``3 octobre 1998`` (SCL-22); Spark's
    ``date_format`` is fixed to English names, so months come from a list."""
    c = _c(col)
    months = F.array(*[F.lit(m) for m in FRENCH_MONTHS])
    return F.concat_ws(" ", F.dayofmonth(c).cast("string"), F.element_at(months, F.month(c)),
                       F.year(c).cast("string"))


def expect(value, cond: Column, message: Column) -> Column:
    """Row-level expectation (SCL-25): the value where ``cond`` holds, else
    null with ``message`` beside it."""
    return F.struct(F.when(cond, _c(value)).alias("value"), F.when(~cond | cond.isNull(), message).alias("error"))
