"""Rates rounded half up in integer arithmetic, so that every engine agrees on the last digit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rate_half_up(part: Column, whole: Column, decimals: int) -> Column:
    """``100 * part / whole`` to ``decimals`` places as a double; NULL when ``whole`` is 0 or either is NULL."""
    scale = 10**decimals
    whole = F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    doubled = part.cast("bigint") * F.lit(200 * scale) + whole
    floored = F.call_function("div", doubled, whole * 2)
    return floored.cast("double") / F.lit(float(scale))
