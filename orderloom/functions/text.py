"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cells a data-frame CSV reader takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# White space of every script, and the four ASCII separators Java leaves out.
_SPACE = r"[\s\x1c-\x1f]+"
_EDGE_SPACE = rf"(?U)\A{_SPACE}|{_SPACE}\z"


def strip_lower(column: Column) -> Column:
    """Lower-case text without white space at its ends (tabs and newlines included)."""
    return F.lower(F.regexp_replace(column, _EDGE_SPACE, ""))


def null_if_token(column: Column) -> Column:
    """Null for a cell that spells a missing value."""
    return F.when(column.isin(NULL_TOKENS), F.lit(None)).otherwise(column)
