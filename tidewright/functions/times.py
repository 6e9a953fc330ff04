"""Elapsed time, calendar parts and age cohorts as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.schemas import AGE_COHORTS

MICROS_PER_DAY = 86_400_000_000


def instant(value: Column) -> Column:
    """Timestamp in the session zone (UTC); naive timestamps and ISO text are read as UTC."""
    return value.cast("timestamp")


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(instant(later)) - F.unix_micros(instant(earlier))


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed 24-hour days, truncated toward zero (``datediff`` would count midnights)."""
    gap = micros_between(later, earlier)
    return ((gap - gap % F.lit(MICROS_PER_DAY)) / F.lit(MICROS_PER_DAY)).cast("int")


def fractional_days(later: Column, earlier: Column) -> Column:
    return micros_between(later, earlier) / F.lit(MICROS_PER_DAY)


def cutoff(as_of: Column, days: int) -> Column:
    """The instant ``days`` times 24 hours before ``as_of``."""
    return instant(as_of) - F.make_dt_interval(F.lit(days))


def age_cohort(days: Column) -> Column:
    """First cohort whose bound exceeds the age; null ages fall through to the last one."""
    chain = None
    for label, bound in AGE_COHORTS:
        if bound is None:
            return chain.otherwise(F.lit(label))
        chain = (F if chain is None else chain).when(days < F.lit(bound), F.lit(label))
    raise ValueError("the last cohort must be unbounded")


def cohort_order(cohort: Column) -> Column:
    """Position of a cohort in its natural order, 1-based; 0 for unknown labels."""
    return F.array_position(F.array(*[F.lit(label) for label, _ in AGE_COHORTS]), cohort).cast("int")


def keep_record(
    scraped_at: Column,
    *,
    after: Column | None = None,
    max_days: int | None = None,
    as_of: Column | None = None,
) -> Column:
    """Retention predicate: a mark wins over an age limit; without either nothing is kept."""
    ts = instant(scraped_at)
    if after is not None:
        return F.coalesce(ts > instant(after), F.lit(False))
    if max_days:
        if as_of is None:
            raise ValueError("max_days needs as_of")
        return F.coalesce(ts >= cutoff(as_of, max_days), F.lit(False))
    return F.lit(False)
