"""Column-level helpers.

Each helper returns a ``Column`` so it composes inside one ``select`` and
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days per mean Gregorian year and per mean Gregorian month (numpy's 'Y' and
# 'M' timedelta units) -- fixed values.
DAYS_PER_YEAR = 365.2425
DAYS_PER_MONTH = 30.436875


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def floor_sql(x: str) -> str:
    """Spark SQL text of floor in double. Spark's own ``floor(double)`` is a BIGINT and stops at 9.2e18."""
    return f"(rint({x}) - CASE WHEN rint({x}) > ({x}) THEN 1.0D ELSE 0.0D END + 0.0D)"


def r6_sql(x: str) -> str:
    """Spark SQL text of ``r6`` applied to the SQL expression ``x``."""
    snapped = f"({floor_sql(f'({x}) * 1.0E9D + 0.5D')} / 1.0E9D)"
    return f"({floor_sql(f'{snapped} * 1000000.0D + 0.5D')} / 1000000.0D)"


def floor_double(c: Column) -> Column:
    """floor in double, for values of any size."""
    whole = F.rint(c)
    return whole - F.when(whole > c, F.lit(1.0)).otherwise(F.lit(0.0)) + F.lit(0.0)


def _snap(c: Column) -> Column:
    return floor_double(c * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9)


def r6(col) -> Column:
    """Round half up to 6 decimals, identically in any IEEE-754 SQL engine.

    Step 1 snaps x onto a 1e-9 grid, so two values that differ only
    by summation-order noise (a few ulps) become the same double; a mean that
    is exactly ``d.dddddd5`` is therefore rounded the same way everywhere.
    Step 2 is floor(x*1e6 + 0.5)/1e6. Both steps are plain IEEE arithmetic in
    double and the same for every size of x: where the grid is finer than a
    double they leave x as it is, to an ulp (an SQL oracle applies the same
    formula). A string argument is taken as an SQL expression (one JVM call).
    """
    if isinstance(col, str):
        return F.expr(r6_sql(col))
    return floor_double(_snap(col) * F.lit(1000000.0) + F.lit(0.5)) / F.lit(1000000.0)


def round_half_up(col, digits: int) -> Column:
    """Round half up to ``digits`` decimals with the same snapping as ``r6``."""
    scale = float(10 ** digits)
    return floor_double(_snap(_c(col)) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def tenure_years(end, start) -> Column:
    """Whole years between two dates, truncated toward zero."""
    days = F.datediff(_c(end), _c(start))
    return (days / F.lit(DAYS_PER_YEAR)).cast("int")


def months_between_ref(ref_date: str, col, negate: bool = False) -> Column:
    """Whole months from ``col`` to ``ref_date`` (truncated); negated after truncation."""
    days = F.datediff(F.lit(ref_date).cast("date"), _c(col))
    months = (days / F.lit(DAYS_PER_MONTH)).cast("int")
    return -months if negate else months


def log10p1(col) -> Column:
    """log10(x + 1); NULL where x + 1 <= 0 (pandas gives -inf / NaN there)."""
    c = _c(col)
    return F.when(c + F.lit(1.0) > 0, F.log10(c + F.lit(1.0)))


def recode_flag(col, true_value: str = "t", false_value: str = "f") -> Column:
    """'t' -> 1, 'f' -> 0, anything else NULL."""
    c = _c(col)
    return F.when(c == true_value, F.lit(1)).when(c == false_value, F.lit(0)).otherwise(
        F.lit(None).cast("int"))


def nonzero_mean(*cols) -> Column:
    """Unweighted mean of the non-zero, non-null inputs; 0.0 when there are none."""
    cs = [_c(c) for c in cols]
    total = sum((F.when(c != 0, c).otherwise(F.lit(0.0)) for c in cs), F.lit(0.0))
    n = sum((F.when(c != 0, F.lit(1)).otherwise(F.lit(0)) for c in cs), F.lit(0))
    return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def hash_bucket(col, salt: int, buckets: int = 10000) -> Column:
    """Stable bucket in [0, buckets) from md5(id || salt).

    Independent of partitioning (``randomSplit`` is not) and reproducible in
    any SQL engine that has md5.
    """
    key = F.concat(_c(col).cast("string"), F.lit(str(salt)))
    hexpart = F.substring(F.md5(key), 1, 8)
    return F.pmod(F.conv(hexpart, 16, 10).cast("bigint"), F.lit(buckets))


def hash_long(col, salt: int) -> Column:
    """Stable hash in [0, 2**60) from md5(id || salt): its first 15 hex digits."""
    key = F.concat(_c(col).cast("string"), F.lit(str(salt)))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
