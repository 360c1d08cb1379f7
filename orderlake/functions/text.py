"""String standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardise_col(c, case: str = "upper") -> Column:
    """Trim, collapse inner runs of white space to one blank, fold case."""
    s = F.regexp_replace(F.trim(_c(c)), r"\s+", " ")
    if case == "upper":
        return F.upper(s)
    if case == "lower":
        return F.lower(s)
    return s


def blank_to_null(c) -> Column:
    """Empty or all-blank text becomes NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))
