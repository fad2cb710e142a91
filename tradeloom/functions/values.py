"""Small scalar rules shared by several tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trailing " - suffix" of a line title, and default labels.
TITLE_SUFFIX = " - [^-]+$"
UNKNOWN_METHOD = "unknown"
UNKNOWN_TITLE = "(unknown)"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def payment_method(gateway: str | Column) -> Column:
    """Lower-cased gateway without outer spaces; blank and NULL are ``unknown``."""
    c = F.col(gateway) if isinstance(gateway, str) else gateway
    return F.coalesce(blank_to_null(F.trim(F.lower(c))), F.lit(UNKNOWN_METHOD))


def product_title(line_title: Column) -> Column:
    """Line title without its variant suffix; blank becomes NULL."""
    return blank_to_null(
        F.regexp_replace(F.coalesce(line_title, F.lit("")), TITLE_SUFFIX, "")
    )


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text (``Z`` or an offset, optional fraction) to a timestamp."""
    return c.cast("timestamp")


def months_after(d: Column, months: int) -> Column:
    return F.add_months(d, months)


def days_before(c: Column, days: int) -> Column:
    return c - F.expr(f"INTERVAL {int(days)} DAYS")
