"""Ordered heads of a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(frame: DataFrame, column: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``column``, equal rows ordered by ``ties``.

    Each task keeps its own ``k`` rows only; nothing is sorted as a whole.
    """
    return frame.orderBy(F.col(column).desc(), *ties).limit(k)


def head(frame: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the order of ``by``, which should name a key."""
    return frame.orderBy(*by).limit(n)
