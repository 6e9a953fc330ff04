"""Pieces of check SQL for DuckDB: title rules, normal distribution, ranks."""

from __future__ import annotations

from tidewright.functions import rules
from tidewright.functions.distributions import (
    HART_BOTTOM,
    HART_TOP,
    WICHURA_CENTRE,
    WICHURA_MIDDLE,
    WICHURA_TAIL,
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re2_pattern(pattern: str) -> str:
    """RE2 reading of a rule pattern: Unicode classes, end of text also before a final newline."""
    out = pattern.replace(r"\w", r"[\p{L}\p{N}_]").replace(r"\s", r"[\s\p{Z}]")
    return out.replace("$", r"\n?$")


def rule_case(subject: str, table: list[tuple[str, str]], default: str) -> str:
    whens = "\n".join(
        f"WHEN regexp_matches({subject}, {quoted(re2_pattern(p))}) THEN {quoted(label)}" for p, label in table
    )
    return f"CASE WHEN {subject} IS NULL THEN NULL\n{whens}\nELSE {quoted(default)} END"


def pillar_case(fmt: str, title: str) -> str:
    return f"""CASE WHEN {fmt} = 'Long-form' THEN {rule_case(title, rules.LONG_FORM_RULES, rules.LONG_FORM_DEFAULT)}
        WHEN {fmt} = 'Short' THEN {rule_case(title, rules.SHORT_RULES, rules.SHORT_DEFAULT)}
        ELSE {rule_case(title, rules.LIVE_RULES, rules.LIVE_DEFAULT)} END"""


def cohort_case(days: str) -> str:
    return f"""CASE WHEN {days} < 30 THEN 'New Release (<30 Days)' WHEN {days} < 180 THEN 'Recent (1-6 Months)'
        WHEN {days} < 720 THEN 'Catalog (6-24 Months)' ELSE 'Legacy (2+ Years)' END"""


def horner(x: str, coefficients: list[float]) -> str:
    out = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def normal_cdf(z: str) -> str:
    a = f"abs({z})"
    near = f"exp(-{a} * {a} / 2) * {horner(a, HART_TOP)} / {horner(a, HART_BOTTOM)}"
    return f"CASE WHEN {z} > 0 THEN 1 - {near} ELSE {near} END"


def normal_quantile(p: str) -> str:
    q, r = f"({p} - 0.5)", f"sqrt(-ln(CASE WHEN {p} < 0.5 THEN {p} ELSE 1 - {p} END))"
    centre = f"(0.180625 - {q} * {q})"
    mid = f"({r} - 1.6)"
    far = f"({r} - 5.0)"
    outer = f"""(CASE WHEN {r} <= 5 THEN {horner(mid, WICHURA_MIDDLE[0])} / {horner(mid, WICHURA_MIDDLE[1])}
        ELSE {horner(far, WICHURA_TAIL[0])} / {horner(far, WICHURA_TAIL[1])} END)"""
    return f"""CASE WHEN abs({q}) <= 0.425 THEN {q} * {horner(centre, WICHURA_CENTRE[0])} / {horner(centre, WICHURA_CENTRE[1])}
        WHEN {q} < 0 THEN -{outer} ELSE {outer} END"""


FEATURES = f"""
    SELECT video_id, title, video_format, {pillar_case('video_format', 'title')} AS content_pillar,
           CAST(year(published_at) AS INTEGER) AS publish_year, CAST(month(published_at) AS INTEGER) AS publish_month,
           {cohort_case("datesub('day', published_at, t1)")} AS video_age_cohort,
           CAST(datesub('day', published_at, t1) AS INTEGER) AS video_age_days,
           CAST(l1 + c1 AS DOUBLE) / nullif(v1, 0) AS lifetime_engagement_rate,
           CAST((l1 - l0) + (c1 - c0) AS DOUBLE) / nullif(v1 - v0, 0) AS marginal_engagement_rate,
           CAST(v1 - v0 AS DOUBLE) / nullif((epoch_us(t1) - epoch_us(t0)) / 86400000000.0, 0) AS daily_view_velocity
    FROM (
        SELECT video_id, min(scraped_at) AS t0, max(scraped_at) AS t1,
               max(view_count) FILTER (WHERE up = 1) AS v0, max(view_count) FILTER (WHERE down = 1) AS v1,
               max(like_count) FILTER (WHERE up = 1) AS l0, max(like_count) FILTER (WHERE down = 1) AS l1,
               max(comment_count) FILTER (WHERE up = 1) AS c0, max(comment_count) FILTER (WHERE down = 1) AS c1
        FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY scraped_at) AS up,
                     row_number() OVER (PARTITION BY video_id ORDER BY scraped_at DESC) AS down
              FROM snapshots
              WHERE scraped_at >= TIMESTAMP '2024-01-05' AND scraped_at < TIMESTAMP '2024-01-26') AS r
        GROUP BY video_id) AS reduced
    LEFT JOIN (SELECT video_id, title, video_format, published_at FROM items) AS i USING (video_id)"""
