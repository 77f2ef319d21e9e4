"""Small column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_CHARACTERS = 7  # "yyyy-MM" at the start of an ISO timestamp


def month_of(timestamp_text: Column) -> Column:
    """The ``yyyy-MM`` prefix of an ISO timestamp held as text."""
    return F.substring(timestamp_text, 1, MONTH_CHARACTERS)


def key_bucket(key: Column, buckets: int) -> Column:
    """A bucket number in [0, buckets) that depends on the key's text alone.

    MD5 is used in place of a Spark hash so that other engines give the same bucket.
    """
    head = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up to two digits, as a double."""
    return F.round(part * F.lit("100.0").cast("decimal(4,1)") / whole, 2).cast("double")
