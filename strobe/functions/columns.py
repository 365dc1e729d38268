"""Column helpers: dotted capture names, numpy-compatible arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Backtick-quote a physical column name such as ``COUNTER1.OUT.Mean``."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column reference that never treats the dots of a capture name as struct access."""
    return F.col(q(name))


def field_column(name: str, capture: str) -> str:
    """Physical column name of a captured field: ``<name>.<capture>``."""
    return f"{name}.{capture}"


def np_divide(num: Column, den: Column) -> Column:
    """Float division with IEEE semantics (x/0 = ±inf, 0/0 = NaN) under ANSI mode.

    Plain ``/`` raises under ANSI and ``try_divide`` yields NULL; the reference
    divides with numpy, so a zero gate must give ±inf or NaN.
    """
    num = num.cast("double")
    den = den.cast("double")
    return (
        F.when(den != 0, num / den)
        .when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(num.isNaN() | (num == 0), F.lit(float("nan")))
        .when(num > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )


def rounded(col: Column, digits: int = 6) -> Column:
    """Round a double for hash-stable comparisons."""
    return F.round(col.cast("double"), digits)
