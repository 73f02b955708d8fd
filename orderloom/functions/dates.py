"""Date arithmetic and canonical date text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_SHAPE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def month_start(column: str) -> Column:
    """First instant of the month; a null time has a null month."""
    return F.date_trunc("month", F.col(column))


def days_late(delivered: str, estimated: str) -> Column:
    """Whole calendar days from the estimate to the delivery, positive when late."""
    return F.datediff(F.col(delivered), F.col(estimated))


def canonical_text(column: str) -> Column:
    """Date text in the one accepted format; anything else is null."""
    text = F.col(column).cast("string")
    # The shape is checked by pattern and the date by a cast, which is much cheaper
    # than parsing by format and writing the same text again.
    return F.when(text.rlike(TEXT_SHAPE) & text.try_cast("timestamp").isNotNull(), text)


def month_from_text(column: str) -> Column:
    """The month text of a mart as a timestamp again."""
    return F.to_timestamp(F.col(column), TEXT_FORMAT)
