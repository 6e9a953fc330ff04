"""Engagement rates and small numeric helpers as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lifetime_rate(likes: Column, comments: Column, views: Column) -> Column:
    """(likes + comments) / views; no views gives null."""
    return F.try_divide(likes + comments, views)


def marginal_rate(
    first_likes: Column, last_likes: Column,
    first_comments: Column, last_comments: Column,
    first_views: Column, last_views: Column,
) -> Column:
    """New likes and comments per new view; no new views gives null, losses give negatives."""
    gained = (last_likes - first_likes) + (last_comments - first_comments)
    return F.try_divide(gained, last_views - first_views)


def view_velocity(first_views: Column, last_views: Column, days: Column) -> Column:
    """New views per elapsed day; a single snapshot gives null."""
    return F.try_divide((last_views - first_views).cast("double"), days)


def float_ratio(top: Column, bottom: Column, on_zero: str = "null") -> Column:
    """Single-precision quotient. ``on_zero='error'`` raises like a database would."""
    quotient = F.try_divide(top.cast("float"), bottom.cast("float")).cast("float")
    if on_zero == "null":
        return quotient
    if on_zero == "error":
        return F.when(bottom == 0, F.raise_error(F.lit("division by zero")).cast("float")).otherwise(
            quotient
        )
    raise ValueError("on_zero must be 'null' or 'error'")


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def decay_value(t: Column, start: Column, rate: Column, floor: Column) -> Column:
    return start * F.exp(-rate * t) + floor


def half_life(rate: Column) -> Column:
    return F.try_divide(F.ln(F.lit(2.0)), rate)


def argmax(scores: Column) -> Column:
    """Zero-based position of the first maximum of an array."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
