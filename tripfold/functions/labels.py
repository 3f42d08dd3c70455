"""Presentation helpers: code labels, text labels, number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripfold import schema as S

# Payment code → label.
PAYMENT_NAMES = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute"}


def payment_name(column: str = S.PAYMENT) -> Column:
    """Code → label through a literal map (NULL for unknown codes)."""
    pairs = []
    for code, name in PAYMENT_NAMES.items():
        pairs += [F.lit(code).cast("bigint"), F.lit(name)]
    return F.element_at(F.create_map(*pairs), F.col(column).cast("bigint"))


def zone_label(zone: str = S.ZONE, borough: str = S.BOROUGH) -> Column:
    """``Zone (Borough)``."""
    return F.concat(F.col(zone), F.lit(" ("), F.col(borough), F.lit(")"))


def millions(column: str) -> Column:
    return F.col(column) / F.lit(1e6)


def millions_label(name: Column, trips: str = "trips") -> Column:
    """``name`` newline ``(x.yM trips)`` with trips in millions, 1 dp."""
    m = F.round(millions(trips), 1).cast("string")
    return F.concat(name, F.lit("\n("), m, F.lit("M trips)"))


def report_number(column: str) -> Column:
    """Table text for a float: 2 dp with separators below a million, else 0 dp."""
    c = F.col(column)
    return F.when(F.abs(c) < F.lit(1e6), F.format_number(c, 2)).otherwise(F.format_number(c, 0))


def report_count(column: str) -> Column:
    """Table text for an integer count, with thousands separators."""
    return F.format_number(F.col(column), 0)


def percent_label(column: str) -> Column:
    """``x.y%`` of a value that is reported with two decimals (halves round up)."""
    return F.concat(F.round(F.col(column).cast("decimal(18,2)"), 1).cast("string"), F.lit("%"))
