"""Hash keys and integer date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a missing key part hashes as, and the joiner of key parts.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
KEY_JOINER = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of one or more columns.

    Each part is defaulted before joining: ``concat_ws`` on its own would skip
    NULLs, and then (1, NULL) and (NULL, 1) would share a key.
    """
    parts = [
        F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in columns
    ]
    return F.md5(F.concat_ws(KEY_JOINER, *parts))


def date_key(c: str | Column) -> Column:
    """``20240131`` as an integer; a timestamp counts in the session time zone.

    Integer arithmetic stays in generated code, unlike ``date_format``.
    """
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
