"""Column expressions for reading measured values."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(column: Column) -> Column:
    """The value as a finite double; other text, NaN and infinity become null."""
    value = column.try_cast("double")
    # NaN counts as larger than any number.
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def measured(column: Column) -> Column:
    """As :func:`as_double`, and zero (the "not measured" mark) becomes null."""
    return F.nullif(as_double(column), F.lit(0.0))


def mean_price(price_in: Column, price_out: Column) -> Column:
    return (price_in + price_out) / F.lit(2.0)
