"""Half-life report: decay table with the dominant format of every pillar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.decay import half_life_table
from tidewright.operators.summaries import group_mode


def half_life_report(
    features: DataFrame,
    group: str = "content_pillar",
    age: str = "video_age_days",
    speed: str = "daily_view_velocity",
    category: str = "video_format",
) -> DataFrame:
    """Every group's half-life with its most frequent format; a label used by several formats is
    fitted over all of them."""
    return half_life_table(features, group, age, speed).join(
        group_mode(features, category, [group]), group, "left"
    )


def dependable(report: DataFrame, group: str = "content_pillar", category: str = "video_format") -> DataFrame:
    """Groups with a usable estimate, slowest decay first."""
    return (
        report.where(F.col("tier").isin("Acceptable", "Reliable"))
        .select(group, category, "half_life_estimate")
        .orderBy(F.desc("half_life_estimate"), F.asc(group))
    )
