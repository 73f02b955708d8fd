"""Casts from text to the types of the data model; a bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Decimal places that sums of amounts keep. At most 6: then 32 places are left in front of the point,
# and a product with a row count keeps them as well.
SCALE = 6


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def amount(df: DataFrame, name: str) -> Column:
    """An amount as a double, or as it is if it is a decimal already."""
    value = F.col(name)
    return value if isinstance(_kind(df, name), T.DecimalType) else value.try_cast("double")


def exact(value: Column, scale: int = SCALE) -> Column:
    """An amount for summing: exact and independent of row order. One that does not fit is an error."""
    infinite = F.abs(value.cast("double")) == float("inf")
    bad = F.raise_error(F.lit("an amount is infinite"))
    return F.when(infinite, bad).otherwise(value.cast(T.DecimalType(38, scale)))


def times(amount: Column, count: Column, scale: int = SCALE) -> Column:
    """An exact amount times a row count; past 32 digits an error and not a wrong number."""
    return (amount * count).cast(T.DecimalType(38, scale))


def whole_number(df: DataFrame, name: str) -> Column:
    """An int; text with a fraction is cut at the point ('4.7' gives 4)."""
    value = F.col(name)
    if isinstance(_kind(df, name), T.StringType):
        value = value.try_cast("double")
    return value.try_cast("int")


def timestamp(df: DataFrame, name: str) -> Column:
    """A timestamp parsed from text; columns that are timestamps already stay as they are."""
    if isinstance(_kind(df, name), (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    return F.try_to_timestamp(F.col(name).cast("string"))


def as_double(df: DataFrame, *names: str) -> DataFrame:
    """Decimal amounts as doubles, for the edge of a mart."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})
