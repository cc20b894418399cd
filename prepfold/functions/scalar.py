"""Column-level helpers.

All of them are built-in expressions, so they stay inside whole-stage codegen.
ANSI mode is on by default in Spark 4: plain ``/`` raises on a zero divisor
and ``to_date`` raises on bad text, so the ``try_`` forms are used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b`` that gives NULL for a zero or NULL divisor."""
    return F.try_divide(col(a), col(b))


def half_up(c: ColumnOrName, digits: int) -> Column:
    """Round half up with plain IEEE operations: ``floor(x*10^d + 0.5) / 10^d``.

    ``round`` on a double differs between engines on half cases (it goes
    through a decimal string in Spark). This form gives the same bits
    everywhere, so keys rounded with it join and compare exactly.
    """
    scale = float(10 ** digits)
    return (F.floor(col(c).cast("double") * F.lit(scale) + F.lit(0.5)).cast("double")
            / F.lit(scale))


def to_double(c: ColumnOrName) -> Column:
    """Text or number to double; bad text becomes NULL instead of raising."""
    return col(c).try_cast("double")


def parse_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text to date; unparsable text gives NULL (``try_to_date``)."""
    if fmt is None:
        return F.try_to_date(col(c))
    return F.try_to_date(col(c), fmt)


def day_of_week(c: ColumnOrName) -> Column:
    """Sunday=1 .. Saturday=7 (Spark ``dayofweek``)."""
    return F.dayofweek(col(c))


def iso_day_of_week(c: ColumnOrName) -> Column:
    """Monday=1 .. Sunday=7 as double: what a weekend ``Binarizer`` with
    threshold 5.0 needs (J1)."""
    return (F.weekday(col(c)) + F.lit(1)).cast("double")


def log_or_null(c: ColumnOrName) -> Column:
    """Natural log; zero or negative input gives NULL."""
    return F.ln(col(c))


def inverse_log(c: ColumnOrName) -> Column:
    """``1 / ln(x)``; ``x = 1`` (log 0) and ``x <= 0`` give NULL."""
    return F.try_divide(F.lit(1.0), F.ln(col(c)))


def like_flag(c: ColumnOrName, one_pattern: str, zero_pattern: str) -> Column:
    """1 where the first LIKE pattern matches, else 0 where the second
    matches, else NULL. The first match wins."""
    x = col(c)
    return (F.when(x.like(one_pattern), F.lit(1))
            .when(x.like(zero_pattern), F.lit(0))
            .otherwise(F.lit(None).cast("int")))


def excluding(c: ColumnOrName, values: list, keep_null: bool = True) -> Column:
    """D2 predicate: not in ``values``; NULL kept when ``keep_null``."""
    x = col(c)
    pred = ~x.isin(values)
    return (pred | x.isNull()) if keep_null else pred


def null_if_above(c: ColumnOrName, bound) -> Column:
    """Overwrite values above ``bound`` with NULL."""
    x = col(c)
    return F.when(x > F.lit(bound), F.lit(None)).otherwise(x)
