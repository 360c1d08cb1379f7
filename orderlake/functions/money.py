"""Money arithmetic in exact decimals.

Source tables store money as double.  Values are cast to decimal *before* any
arithmetic or summation so that sums do not depend on the order in which
partitions are combined; results are presented as rounded doubles at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"   # one amount
RATE = "decimal(4,2)"     # discount, tax
TOTAL = "decimal(38,4)"   # sums over any number of rows


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _c(c).cast(MONEY)


def rate(c) -> Column:
    return _c(c).cast(RATE)


def gross_amount(price="l_extendedprice") -> Column:
    return money(price)


def discount_amount(price="l_extendedprice", disc="l_discount") -> Column:
    return money(price) * rate(disc)


def net_amount(price="l_extendedprice", disc="l_discount") -> Column:
    """Revenue of a line: price x (1 - discount), exact."""
    return money(price) * (F.lit(1) - rate(disc))


def tax_amount(price="l_extendedprice", disc="l_discount", tax="l_tax") -> Column:
    return net_amount(price, disc) * rate(tax)


def total(c) -> Column:
    """Sum of a decimal expression with a result type wide enough for any scale."""
    return F.sum(_c(c)).cast(TOTAL)


def present_money(c, scale: int = 2) -> Column:
    """Round an exact amount half-up and hand it out as double."""
    return F.round(_c(c), scale).cast("double")
