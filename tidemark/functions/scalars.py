"""Column functions: parsing, rounding, dates and release calendars. All are built-in expressions, none a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_double(text: Column) -> Column:
    """A number in text with thousands' commas; empty, ``-``, ``(S)``, ``(NA)`` and other words are null."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def parse_date(text: Column) -> Column:
    """ISO, YYYY/MM/DD, M/D/YYYY, YYYYMnn (month 1 to 12) and YYYYQn dates; anything else is null."""
    month = F.regexp_extract(text, r"^(\d{4})M(0[1-9]|1[0-2])$", 2)
    quarter = F.lower(F.regexp_extract(text, r"^\d{4}[Qq]([1-4])$", 1))
    year = F.substring(text, 1, 4).try_cast("int")
    return (
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "y-M-d"))
        .when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.try_to_date(text, "y/M/d"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(text, "M/d/y"))
        .when(month != "", F.make_date(year, month.try_cast("int"), F.lit(1)))
        .when(quarter != "", F.make_date(year, quarter.try_cast("int") * 3 - 2, F.lit(1)))
    )


def fix_two_digit_year(date: Column, pivot: int = 2050) -> Column:
    """Dates from the pivot year on were meant a century earlier."""
    return F.when(F.year(date) >= pivot, F.add_months(date, -1200)).otherwise(date)


def split_sample(text: Column) -> tuple[Column, Column]:
    """``1000 LV`` to (1000, LV)."""
    return F.regexp_extract(text, r"^\s*(\d+)", 1).try_cast("long"), F.nullif(F.upper(F.regexp_extract(text, r"([A-Za-z]+)\s*$", 1)), F.lit(""))


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def round_half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def positive_part(x: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def negative_part(x: Column) -> Column:
    return F.when(x.isNotNull(), F.least(x, F.lit(0.0)))


def balance_to_index(balance: Column) -> Column:
    """A balance of -100..100 as a diffusion index around 50."""
    return F.lit(50.0) + balance / 2


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; null for a zero or null divisor and for infinite results."""
    x = F.try_divide(a, b)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def epoch_to_local_date(seconds: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(F.timestamp_seconds(seconds), zone))


def in_period(date: Column, low: str, high: str) -> Column:
    return date.between(F.lit(low).cast("date"), F.lit(high).cast("date"))


def month_dummies(date: Column, base: int = 1) -> list[Column]:
    return [F.when(F.month(date) == m, 1.0).otherwise(0.0).alias(f"m{m}") for m in range(1, 13) if m != base]


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def nth_weekday(date: Column, day: str, n: int = 1) -> Column:
    """The n-th such weekday of the date's month."""
    return F.date_add(F.next_day(F.date_sub(F.trunc(date, "MM"), 1), day), 7 * (n - 1))


def business_days_in_month(date: Column) -> Column:
    """Which business day (Monday to Friday) of its month a date is, counting up to and including it."""
    days = F.sequence(F.trunc(date, "MM"), date)
    return F.size(F.filter(days, lambda d: F.weekday(d) < 5)).cast("long")


def reference_week_tuesday(date: Column, day: int = 13) -> Column:
    """Tuesday of the Sunday-to-Saturday week that holds the given day of the month."""
    mark = F.date_add(F.trunc(date, "MM"), day - 1)
    return F.date_add(mark, F.lit(3) - F.dayofweek(mark))


def expected_weekdays(date: Column, weekday: int = 5) -> Column:
    """How often a weekday (Monday 0) occurs in the date's month."""
    return F.size(F.filter(F.sequence(F.trunc(date, "MM"), F.last_day(date)), lambda d: F.weekday(d) == weekday)).cast("long")


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean over columns, nulls left out."""
    kept = F.filter(F.array(*[c.cast("double") for c in columns]), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / F.size(kept))


def student_t4_cdf(t: Column) -> Column:
    """Closed-form distribution function of Student's t with 4 degrees of freedom."""
    q = t * t / 4
    return F.lit(0.5) + F.lit(0.375) * (t / F.sqrt(1 + q)) * (1 - t * t / (12 * (1 + q)))


# Coefficients of the rational approximations to erf and erfc by W. J. Cody (Mathematics of Computation 23, 1969).
_ERF_P = [3.16112374387056560e00, 1.13864154151050156e02, 3.77485237685302021e02, 3.20937758913846947e03, 1.85777706184603153e-1]
_ERF_Q = [2.36012909523441209e01, 2.44024637934444173e02, 1.28261652607737228e03, 2.84423683343917062e03]
_ERFC_P = [5.64188496988670089e-1, 8.88314979438837594e00, 6.61191906371416295e01, 2.98635138197400131e02, 8.81952221241769090e02,
           1.71204761263407058e03, 2.05107837782607147e03, 1.23033935479799725e03, 2.15311535474403846e-8]
_ERFC_Q = [1.57449261107098347e01, 1.17693950891312499e02, 5.37181101862009858e02, 1.62138957456669019e03, 3.29079923573345963e03,
           4.36261909014324716e03, 3.43936767414372164e03, 1.23033935480374942e03]
_TAIL_P = [3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4, 1.63153871373020978e-2]
_TAIL_Q = [2.56852019228982242e00, 1.87295284992346725e00, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3]


def _polynomial(x: Column, first: float, rest: Sequence[float]) -> Column:
    """first * x^n + rest[0] * x^(n-1) + ... + rest[-1]."""
    out = F.lit(first)
    for c in rest:
        out = out * x + F.lit(c)
    return out


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution function by built-in expressions, to about 1e-15; far in the lower tail relative to its value.
    Null and NaN stay."""
    z = z.cast("double")
    x = F.abs(z) / F.lit(2.0**0.5)
    square, inverse = x * x, F.lit(1.0) / (x * x)
    near = x * _polynomial(square, _ERF_P[4], _ERF_P[:4]) / _polynomial(square, 1.0, _ERF_Q)
    middle = F.exp(-square) * _polynomial(x, _ERFC_P[8], _ERFC_P[:8]) / _polynomial(x, 1.0, _ERFC_Q)
    rest = inverse * _polynomial(inverse, _TAIL_P[5], _TAIL_P[:5]) / _polynomial(inverse, 1.0, _TAIL_Q)
    far = F.exp(-square) / x * (F.lit(1 / 3.141592653589793**0.5) - rest)
    # half of erfc of |z| / sqrt(2): what lies beyond |z|
    beyond = F.when(x <= 0.46875, (1 - near) / 2).when(x <= 4, middle / 2).when(x < 27, far / 2).otherwise(F.lit(0.0))
    return F.when(F.isnan(z), z).when(z > 0, 1 - beyond).when(z.isNotNull(), beyond)


def missing_names(df: DataFrame, columns: Sequence[str]) -> Column:
    """Names of the columns that are null in a row."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
