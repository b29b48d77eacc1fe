"""Score rounding and ordering rules.

Scores that are summed or ranked later are integers counted in millionths
(``m6``); scores only reported are doubles rounded half-up to six decimals
(``r6``).  Both round one way only, so two engines that compute the same double
agree on the rounded value; ``round`` is never used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def m6(x) -> Column:
    """Score as a bigint count of millionths: floor(x * 1e6 + 0.5)."""
    return F.floor(_col(x) * F.lit(1e6) + F.lit(0.5)).cast("bigint")


def r6(x) -> Column:
    """Reported double rounded half-up to six decimals."""
    return (F.floor(_col(x) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).cast("double")


def rank_order(score: str = "score", key: str = "item_id") -> list[Column]:
    """The one ranking order used everywhere: score descending, then id ascending."""
    return [F.col(score).desc(), F.col(key).asc()]
