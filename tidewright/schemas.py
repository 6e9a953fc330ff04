"""Declared schemas, domains and constants of the data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Labels and limits the results must carry verbatim.
VIDEO_FORMATS = ["Live/VOD", "Long-form", "Short"]
LONG_FORM = "Long-form"
SHORT = "Short"
TRANSCRIBED_FORMATS = ["Long-form", "Live/VOD"]
UNKNOWN_FORMAT = "Unknown"
UNKNOWN_AUTHOR = "Unknown"
FAILED_FETCH = "FAILED_FETCH"
LINK_PREFIX = "https://www.youtube.com/watch?v="
UPLOAD_LIST_PREFIXES = {"Long-form": "UULF", "Short": "UUSH", "Live/VOD": "UULV"}
AGE_COHORTS = [
    ("New Release (<30 Days)", 30),
    ("Recent (1-6 Months)", 180),
    ("Catalog (6-24 Months)", 720),
    ("Legacy (2+ Years)", None),
]
SENTIMENT_LABELS = ["negative", "neutral", "positive"]
ALWAYS_KEPT_LANGUAGES = [
    "arb_Arab", "eng_Latn", "fra_Latn", "deu_Latn", "hin_Deva", "ita_Latn", "spa_Latn", "por_Latn",
]
RELIABILITY_TIERS = [("Reliable", 10), ("Acceptable", 20), ("Proceed with Caution", 40)]
LOWEST_TIER = "Unreliable"
ID_BATCH_SIZE = 50
TRANSCRIPT_LIMIT = 40
TABLE_RETENTION_DAYS = 7
JSONL_RETENTION_DAYS = 3
SAMPLE_SIZE = 384
ALPHA = 0.05


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _T, _L, _I = StringType(), TimestampType(), LongType(), IntegerType()

# Nested payloads as they arrive. Every key is optional; counters arrive as strings.
# The two readings of a video payload parse only the half they need.
VIDEO_SNIPPET_PAYLOAD = _struct(
    items=ArrayType(
        _struct(
            id=_S,
            snippet=_struct(
                publishedAt=_S, title=_S, description=_S, categoryId=_S, tags=ArrayType(_S)
            ),
        )
    )
)
VIDEO_STATS_PAYLOAD = _struct(
    items=ArrayType(_struct(id=_S, statistics=_struct(viewCount=_S, likeCount=_S, commentCount=_S)))
)
COMMENT_PAYLOAD = _struct(
    items=ArrayType(
        _struct(
            id=_S,
            snippet=_struct(
                topLevelComment=_struct(
                    snippet=_struct(
                        authorDisplayName=_S, textDisplay=_S, likeCount=_L, publishedAt=_S
                    )
                )
            ),
        )
    )
)

REGISTRY = _struct(video_id=_S, video_format=_S, first_scraped_at=_T)
RAW_VIDEOS = _struct(scraped_at=_T, video_response=_S)
RAW_COMMENTS = _struct(video_id=_S, scraped_at=_T, comment_response=_S)
SNIPPETS = _struct(
    video_id=_S, published_at=_T, video_format=_S, title=_S, description=_S,
    category_id=_S, tags=_S, video_link=_S, scraped_at=_T,
)
TRANSCRIPTS = _struct(video_id=_S, transcript=_S)
STATS = _struct(video_id=_S, scraped_at=_T, view_count=_L, like_count=_L, comment_count=_L)
COMMENTS = _struct(
    comment_id=_S, video_id=_S, author=_S, text=_S, like_count=_I, published_at=_T, scraped_at=_T
)

# Integrity rules of the data model, used by operators.integrity.
PRIMARY_KEYS = {
    "registry": ["video_id"],
    "raw_videos": ["scraped_at"],
    "raw_comments": ["video_id", "scraped_at"],
    "snippets": ["video_id"],
    "transcripts": ["video_id"],
    "stats": ["video_id", "scraped_at"],
    "comments": ["comment_id", "scraped_at"],
}
FOREIGN_KEYS = {
    "raw_comments": ("registry", "video_id"),
    "transcripts": ("snippets", "video_id"),
    "stats": ("snippets", "video_id"),
    "comments": ("snippets", "video_id"),
}
NOT_NULL = {
    "registry": ["video_id", "first_scraped_at"],
    "snippets": ["video_id", "published_at", "title"],
    "stats": ["video_id", "scraped_at"],
    "comments": ["comment_id", "scraped_at"],
}
DEFAULTS = {
    "stats": {"view_count": 0, "like_count": 0, "comment_count": 0},
    "comments": {"like_count": 0},
}
