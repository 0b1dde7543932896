"""Blank semantics of the measure layer, as column expressions.

A blank (null) counts as zero in sums and comparisons, yields blank in products and quotients, and
text compares without regard to case. Every helper is a plain expression, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank0(c: ColumnLike) -> Column:
    """The value, a blank as 0."""
    return F.coalesce(col(c), F.lit(0))


def is_zero(c: ColumnLike) -> Column:
    """Whether a value equals 0; a blank does."""
    return blank0(c) == 0


def plus(*cs: ColumnLike) -> Column:
    """Sum in which blanks don't count; blank only if all are."""
    total = reduce(lambda a, b: a + b, (blank0(c) for c in cs))
    return F.when(F.coalesce(*map(col, cs)).isNotNull(), total)


def minus(a: ColumnLike, b: ColumnLike) -> Column:
    """Difference in which blanks don't count; blank only if both are."""
    return F.when(F.coalesce(col(a), col(b)).isNotNull(), blank0(a) - blank0(b))


def times(*cs: ColumnLike) -> Column:
    """Product; blank if any factor is."""
    return reduce(lambda a, b: a * b, map(col, cs))


def divide(a: ColumnLike, b: ColumnLike, alternate: ColumnLike | float | None = None) -> Column:
    """Quotient in double precision; `alternate` (default blank) if the divisor is 0 or blank."""
    q = F.try_divide(col(a).cast("double"), col(b).cast("double"))
    if alternate is None:
        return q
    other = F.lit(alternate) if isinstance(alternate, (int, float)) else col(alternate)
    return F.when(is_zero(b), other.cast("double")).otherwise(q)


def least0(a: ColumnLike, b: ColumnLike) -> Column:
    """The smaller of two values, a blank as 0."""
    return F.least(blank0(a), blank0(b))


def greatest0(a: ColumnLike, b: ColumnLike) -> Column:
    """The larger of two values, a blank as 0."""
    return F.greatest(blank0(a), blank0(b))


def ci_eq(a: ColumnLike, b: ColumnLike | str) -> Column:
    """Equality of text without regard to case; b: a column, or a plain string."""
    other = F.lit(b.lower()) if isinstance(b, str) else F.lower(b)
    return F.lower(col(a)) == other


def round_twice(c: ColumnLike, first: int = 3, then: int = 2) -> Column:
    """Rounds half up to `first` places and the result to `then` places, in decimal arithmetic."""
    d = F.round(col(c).cast("decimal(28,10)"), first)
    return F.round(d, then)
