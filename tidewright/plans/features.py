"""The feature table: one row per video with engagement features over an analysis window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.rates import float_ratio, lifetime_rate, marginal_rate, view_velocity
from tidewright.functions.rules import content_pillar
from tidewright.functions.times import age_cohort, fractional_days, instant, whole_days
from tidewright.operators.integrity import enforce_domain, in_domain, unsigned
from tidewright.operators.snapshots import first_and_last, in_window
from tidewright.schemas import VIDEO_FORMATS

# The default analysis window, half-open, UTC.
WINDOW_START, WINDOW_END = "2026-05-17 00:00:00", "2026-06-16 00:00:00"
COUNTERS = ["view_count", "like_count", "comment_count"]


def window_reduction(
    stats: DataFrame, snippets: DataFrame, start: str = WINDOW_START, end: str = WINDOW_END
) -> DataFrame:
    """First and last counters in the window with the video's title, format and publication.

    The snapshots are reduced to one row per video before the join, so the join moves videos, not
    snapshots.
    """
    reduced = first_and_last(
        stats.where(in_window(F.col("scraped_at"), start, end)), "video_id", "scraped_at", COUNTERS
    )
    return reduced.join(
        snippets.select("video_id", "title", "video_format", "published_at"), "video_id", "left"
    )


def make_features(
    stats: DataFrame,
    snippets: DataFrame,
    sentiment: DataFrame | None = None,
    start: str = WINDOW_START,
    end: str = WINDOW_END,
    on_bad_format: str = "error",
) -> DataFrame:
    """The 12-column feature table (11 without ``sentiment``).

    ``on_bad_format``: 'error' raises on a format outside the domain, 'drop' leaves such videos out
    (see `quarantined_formats` for them).
    """
    base = window_reduction(stats, snippets, start, end)
    if on_bad_format == "error":
        base = enforce_domain(base, "video_format", VIDEO_FORMATS)
    elif on_bad_format == "drop":
        base = base.where(in_domain(F.col("video_format"), VIDEO_FORMATS))
    else:
        raise ValueError("on_bad_format must be 'error' or 'drop'")
    age = whole_days(F.col("last_scraped_at"), F.col("published_at"))
    likes0, likes1 = F.col("earliest_like_count"), F.col("latest_like_count")
    notes0, notes1 = F.col("earliest_comment_count"), F.col("latest_comment_count")
    views0, views1 = F.col("earliest_view_count"), F.col("latest_view_count")
    strict = on_bad_format == "error"
    features = base.select(
        "video_id",
        "title",
        "video_format",
        content_pillar(F.col("video_format"), F.col("title")).alias("content_pillar"),
        F.year(instant(F.col("published_at"))).alias("publish_year"),
        F.month(instant(F.col("published_at"))).alias("publish_month"),
        age_cohort(age).alias("video_age_cohort"),
        unsigned(age, 65535, strict).alias("video_age_days"),
        lifetime_rate(likes1, notes1, views1).alias("lifetime_engagement_rate"),
        marginal_rate(likes0, likes1, notes0, notes1, views0, views1).alias("marginal_engagement_rate"),
        view_velocity(
            views0, views1, fractional_days(F.col("last_scraped_at"), F.col("first_scraped_at"))
        ).alias("daily_view_velocity"),
    )
    if sentiment is None:
        return features
    return features.join(
        sentiment.select("video_id", "positive_sentiment_percentage"), "video_id", "left"
    )


def quarantined_formats(
    stats: DataFrame, snippets: DataFrame, start: str = WINDOW_START, end: str = WINDOW_END
) -> DataFrame:
    """Videos the feature table cannot take because of their format."""
    base = window_reduction(stats, snippets, start, end)
    return base.where(~in_domain(F.col("video_format"), VIDEO_FORMATS))


def ratio_report(stats: DataFrame, snippets: DataFrame, limit: int = 50) -> DataFrame:
    """The earlier ratio report: all snapshots, inner join, likes only in single precision, age taken
    from the metadata scrape, oldest publications first."""
    reduced = first_and_last(stats, "video_id", "scraped_at", ["view_count", "like_count"])
    joined = reduced.join(
        snippets.select(
            "video_id", "title", "video_format", "published_at", F.col("scraped_at").alias("_seen")
        ),
        "video_id",
    )
    gained = F.col("latest_view_count") - F.col("earliest_view_count")
    days = fractional_days(F.col("last_scraped_at"), F.col("first_scraped_at"))
    return (
        joined.orderBy("published_at", "video_id")
        .limit(limit)
        .select(
            "video_id",
            "title",
            "video_format",
            age_cohort(whole_days(F.col("_seen"), F.col("published_at"))).alias("video_age_days"),
            float_ratio(F.col("latest_like_count"), F.col("latest_view_count")).alias("like_to_view_ratio"),
            float_ratio(F.col("latest_like_count") - F.col("earliest_like_count"), gained).alias(
                "margin_like_to_view_ratio"
            ),
            F.try_divide(gained.cast("float").cast("double"), days).alias("daily_view_velocity"),
        )
    )
