"""Text helpers as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.schemas import LINK_PREFIX, SENTIMENT_LABELS, UPLOAD_LIST_PREFIXES


def flatten_lines(text: Column) -> Column:
    """Newlines become spaces, null becomes the empty string."""
    return F.translate(F.coalesce(text, F.lit("")), "\n", " ")


def strip_label_prefix(label: Column, prefix: str = "__label__") -> Column:
    return F.replace(label, F.lit(prefix), F.lit(""))


def join_tags(tags: Column) -> Column:
    """Comma-joined tags; missing tags give the empty string."""
    return F.coalesce(F.array_join(tags, ","), F.lit(""))


def video_link(video_id: Column) -> Column:
    return F.concat(F.lit(LINK_PREFIX), video_id)


def upload_list_id(channel_id: Column, video_format: str) -> Column:
    """Id of the per-format upload list of a channel."""
    return F.concat(
        F.lit(UPLOAD_LIST_PREFIXES[video_format]), F.replace(channel_id, F.lit("UC"), F.lit(""))
    )


def excerpt(text: Column, length: int = 100) -> Column:
    """Leading characters for display."""
    return F.substring(text, 1, length)


def label_name(code: Column) -> Column:
    """0/1/2 to negative/neutral/positive; codes outside the vocabulary give null."""
    names = F.array(*[F.lit(name) for name in SENTIMENT_LABELS])
    return F.try_element_at(names, (code + 1).cast("int"))


def label_code(name: Column) -> Column:
    """negative/neutral/positive to 0/1/2; other names give null."""
    names = F.array(*[F.lit(n) for n in SENTIMENT_LABELS])
    return F.nullif(F.array_position(names, name) - 1, F.lit(-1)).cast("int")


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; never null, never holds empty strings."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
