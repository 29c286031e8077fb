"""Scalar expressions. All stay JVM-side and inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash32(key: Column, seed: int = 0) -> Column:
    """First 32 bits of md5(key|seed) as a bigint."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_uniform(key: Column, seed: int = 0) -> Column:
    """A reproducible uniform number in [0, 1) for each key."""
    return hash32(key, seed) / F.lit(float(TWO_32))


def row_key(cols: Iterable[str]) -> Column:
    """The key columns joined by '|', for hashing."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def ratio_or_null(num: Column, den: Column) -> Column:
    """num / den in double; null where the denominator is zero or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio_or_null(num, den), F.lit(0.0))


def clean(c: str | Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.trim(F.lower(col(c)))


def flag_in(c: Column, values: Iterable[str]) -> Column:
    """True when c is one of values; false otherwise and on null."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def email_domain(c: str | Column) -> Column:
    """Word after '@'; 'NA' for a missing address, null when there is no '@'."""
    return F.nullif(F.regexp_extract(F.coalesce(col(c), F.lit("xx@NA")), r"@(\w+)", 1), F.lit(""))


def years_apart(earlier: Column, later: Column) -> Column:
    """Number of calendar-year boundaries between two dates."""
    return F.year(later) - F.year(earlier)


def day_number(c: str | Column) -> Column:
    return F.unix_date(col(c).cast("date"))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0))


def logistic(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def daily_from_weekly(p: Column) -> Column:
    """Daily probability whose seven-day complement is 1 - p."""
    return 1.0 - F.pow(1.0 - p, F.lit(1.0 / 7.0))


def dt_lit(d: date) -> Column:
    return F.lit(d)


def array_max_fixed(arr: str | Column, n: int) -> Column:
    """Largest of the first n elements of an array."""
    return F.greatest(*[F.get(col(arr), F.lit(i)) for i in range(n)])


def array_sum_fixed(arr: str | Column, n: int) -> Column:
    """Sum of the first n elements; null if one of them is missing."""
    total = F.get(col(arr), F.lit(0))
    for i in range(1, n):
        total = total + F.get(col(arr), F.lit(i))
    return total


def array_avg_fixed(arr: str | Column, n: int) -> Column:
    """Sum of the first n elements divided by the declared length n."""
    return array_sum_fixed(arr, n) / F.lit(n)
