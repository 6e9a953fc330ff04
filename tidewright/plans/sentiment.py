"""Comment scoring: latest comments, language, frequent-language filter, label, share per video."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.frames import only_listed, value_list
from tidewright.operators.snapshots import in_window, latest_row
from tidewright.operators.summaries import class_share, leading_values
from tidewright.plans.features import WINDOW_END, WINDOW_START
from tidewright.schemas import ALWAYS_KEPT_LANGUAGES
from tidewright.session import cut_lineage

Step = Callable[[DataFrame], DataFrame]


def latest_comments(
    comments: DataFrame, start: str = WINDOW_START, end: str = WINDOW_END
) -> DataFrame:
    """The latest state of every comment seen in the window."""
    seen = comments.where(in_window(F.col("scraped_at"), start, end))
    return latest_row(
        seen.select("video_id", "comment_id", "text", "scraped_at"),
        ["comment_id"],
        [F.desc("scraped_at"), F.asc("video_id")],
    ).drop("scraped_at")


def keep_frequent_languages(
    df: DataFrame, always: list[str] | None = None, percent: int = 90
) -> DataFrame:
    """Rows in a language of the leading ``percent`` of the data, or in one that is always kept."""
    fixed = value_list(df.sparkSession, ALWAYS_KEPT_LANGUAGES if always is None else always, "language")
    return only_listed(df, "language", leading_values(df, "language", percent).select("language"), fixed)


def positive_share(scored: DataFrame) -> DataFrame:
    """Share of positive comments per video among the comments in kept languages."""
    return class_share(scored, "video_id", "sentiment_label", "positive", "positive_sentiment_percentage")


def score_comments(
    comments: DataFrame,
    add_language: Step,
    add_label: Step,
    start: str = WINDOW_START,
    end: str = WINDOW_END,
    always: list[str] | None = None,
) -> DataFrame:
    """(video_id, comment_id, text, language, sentiment_label) of the kept comments.

    Both scorers are expensive, so each result is materialised once and read by everything after
    it: languages by the frequency count and the filter, labels by storage and the share.
    """
    with_language = cut_lineage(add_language(latest_comments(comments, start, end)))
    labelled = add_label(keep_frequent_languages(with_language, always))
    return cut_lineage(labelled.select("video_id", "comment_id", "text", "language", "sentiment_label"))


def run_sentiment(
    comments: DataFrame,
    add_language: Step,
    add_label: Step,
    out_dir: str | None = None,
    **window,
) -> DataFrame:
    """Score, optionally store the scored comments and the shares, and return the shares."""
    scored = score_comments(comments, add_language, add_label, **window)
    shares = positive_share(scored)
    if out_dir is not None:
        scored.write.mode("overwrite").parquet(f"{out_dir}/comment_sentiment")
        shares.write.mode("overwrite").parquet(f"{out_dir}/video_sentiment_result")
    return shares
