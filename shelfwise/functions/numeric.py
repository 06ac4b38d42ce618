"""Rounding and ratio expressions.

Two rounding families exist in the source semantics:

* SQL ``ROUND`` rounds half away from zero.  We round in decimal space
  (double -> decimal(38, max(10, d + 4)) -> round) so that a value printed as 5.005
  rounds to 5.01 regardless of its binary representation.
* numpy/pandas ``round`` is IEEE round-half-even on the binary value:
  ``rint(x * 10^d) / 10^d``.

Division is always ``try_divide`` (NULL on a zero denominator), because
ANSI mode raises on division by zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, d: int = 2) -> Column:
    """SQL ROUND(x, d) of a double/decimal, returned as double.  The value
    passes through a decimal with at least four guard digits beyond ``d``."""
    return F.round(_c(x).cast(f"decimal(38,{max(10, d + 4)})"), d).cast("double")


def half_even(x, d: int = 0) -> Column:
    """numpy ``round(x, d)`` (IEEE half-even on the binary value), as double."""
    if d == 0:
        return F.rint(_c(x).cast("double"))
    s = float(10 ** d)
    return F.rint(_c(x).cast("double") * F.lit(s)) / F.lit(s)


def as_double(x) -> Column:
    return _c(x).cast("double")


def ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return F.try_divide(as_double(num), as_double(den))


def pct(num, den, d: int = 2) -> Column:
    """ROUND(num / den * 100, d); NULL when den is 0."""
    return round_half_up(ratio(num, den) * F.lit(100.0), d)


def money(x, d: int = 2) -> Column:
    """ROUND of an exact decimal amount, returned as double."""
    return F.round(_c(x), d).cast("double")


def avg_money(total, n) -> Column:
    """ROUND(total / n, 2) for a non-negative decimal money total, exact.

    Works in integer cents: round-half-up of cents/n equals
    floor((2*cents + n) / (2*n)); the floor is taken with ``pmod`` so no
    double ever holds an unrounded quotient.  NULL when n is 0.
    """
    cents = (_c(total) * F.lit(100)).cast("long")
    n = _c(n).cast("long")
    num = cents * 2 + n
    den = n * 2
    q = ((num - F.pmod(num, den)) / den).cast("long")
    return F.when(n > 0, q.cast("double") / F.lit(100.0))


def exact_std(x) -> Column:
    """Sample standard deviation of an integer column from exact moment sums.

    n, sum(x) and sum(x^2) are long aggregates (exact; they raise on
    overflow under ANSI rather than wrap) and are combined per group as
    (n * sum(x^2) - sum(x)^2) / (n * (n - 1)) in decimal(38,0).  The result
    is therefore the same number whatever order partial aggregates merge in
    (``stddev_samp`` can differ in the last bits between runs); NULL for a
    single observation, like ``stddev_samp``."""
    xl = _c(x).cast("long")
    wide = lambda c: c.cast("decimal(38,0)")
    n, s1, s2 = F.count(xl), F.sum(xl), F.sum(xl * xl)
    num = wide(n) * wide(s2) - wide(s1) * wide(s1)
    return F.sqrt(F.try_divide(num.cast("double"), (n * (n - 1)).cast("double")))
