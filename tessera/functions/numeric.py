"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = float(2 ** 52)  # from here on every double is a whole number


def fround(col, digits: int = 0) -> Column:
    """Round a double half away from zero on its *binary* value:
    ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Spark's ``round`` rounds the double's shortest decimal string half-up
    (259.4215 -> 259.422 although the double is 259.42149999...), while
    C-family engines round the binary value (-> 259.421).  This form is
    plain IEEE arithmetic, so it gives bit-identical results in any engine
    that evaluates the same formula.  It stays in double precision (no
    integer cast that could overflow) and returns values too large to carry
    fractional digits unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    m = float(10 ** digits)
    v = F.abs(c) * m + 0.5
    whole = v - (v % 1.0)
    return F.when(F.abs(c) * m >= _EXACT, c).otherwise(F.signum(c) * whole / m)
