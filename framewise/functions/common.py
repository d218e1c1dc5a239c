"""Small Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(c)))


def safe_div(a, b) -> Column:
    """Division that yields null (not inf/nan/error) for a zero denominator."""
    return F.try_divide(col(a), col(b))


def round6(c) -> Column:
    return F.round(col(c), 6)


def epoch_micros(c) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ columns."""
    return F.unix_micros(col(c).cast("timestamp"))
