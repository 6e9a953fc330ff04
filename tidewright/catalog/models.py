"""Sampling, evaluation, scoring and end-to-end queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.shapes import WINDOW, Tables
from tidewright.functions.text import label_name
from tidewright.operators import evaluation, sampling, scoring
from tidewright.operators.ingest import joined_segments
from tidewright.operators.snapshots import in_window, latest_row
from tidewright.plans.features import make_features, quarantined_formats, ratio_report
from tidewright.plans.sentiment import latest_comments, positive_share, run_sentiment, score_comments


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- evaluation


@query("a16_misclassified", "SELECT comment_id, label, prediction FROM predictions WHERE label <> prediction OR prediction IS NULL")
def a16(t: Tables) -> DataFrame:
    return evaluation.misclassified(t.predictions(), "label", "prediction").select("comment_id", "label", "prediction")


@query(
    "a16_error_rate",
    """SELECT count(*) AS n, count(*) FILTER (WHERE label IS DISTINCT FROM prediction) AS n_wrong,
              round(count(*) FILTER (WHERE label IS DISTINCT FROM prediction) / count(*), 8) AS error_rate FROM predictions""",
)
def a16b(t: Tables) -> DataFrame:
    return rounded(evaluation.error_rate(t.predictions(), "label", "prediction"), 8, "error_rate")


CELLS_SQL = """
    WITH cells AS (SELECT CAST(a.i AS INTEGER) AS label, CAST(b.i AS INTEGER) AS prediction,
                          (SELECT count(*) FROM predictions AS p WHERE p.label = a.i AND p.prediction = b.i) AS n
                   FROM range(3) AS a(i) CROSS JOIN range(3) AS b(i)),
    scores AS (SELECT k.i AS class, (SELECT CAST(sum(n) AS BIGINT) FROM cells WHERE label = k.i) AS support,
                      (SELECT CAST(sum(n) AS BIGINT) FROM cells WHERE label = k.i AND prediction = k.i) AS tp,
                      (SELECT sum(n) FROM cells WHERE prediction = k.i) AS claimed FROM range(3) AS k(i)),
    rates AS (SELECT *, coalesce(tp / nullif(claimed, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r FROM scores),
    f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM rates)"""


@query("a17_confusion_matrix", CELLS_SQL + " SELECT label, prediction, n FROM cells")
def a17(t: Tables) -> DataFrame:
    return evaluation.confusion_matrix(t.predictions(), "label", "prediction")


@query(
    "a18_class_scores",
    CELLS_SQL + " SELECT CAST(class AS INTEGER) AS class, support, tp, round(p, 8) AS precision, round(r, 8) AS recall, round(f1, 8) AS f1 FROM f",
)
def a18(t: Tables) -> DataFrame:
    return rounded(evaluation.class_scores(evaluation.confusion_matrix(t.predictions(), "label", "prediction")), 8, "precision", "recall", "f1")


@query(
    "a18_overall_scores",
    CELLS_SQL + """ SELECT round(sum(tp) / sum(support), 8) AS accuracy, round(avg(f1), 8) AS macro_f1,
                    round(sum(f1 * support) / sum(support), 8) AS weighted_f1 FROM f""",
)
def a18b(t: Tables) -> DataFrame:
    return rounded(evaluation.evaluate(t.predictions(), "label", "prediction"), 8, "accuracy", "macro_f1", "weighted_f1")


# ---- sampling


@query("l01_sample_rows", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':8'), doc_id LIMIT 384")
def l01(t: Tables) -> DataFrame:
    return sampling.sample_rows(t.table("documents").select("doc_id", "lang"), "doc_id", sampling.sample_size(), 8)


DRAWS = [(2, 1, 300), (2, 2, 300), (1, 1, 300), (1, 2, 300), (1, 3, 300)] + [(0, seed, 300) for seed in range(1, 10)]


@query(
    "l02_sample_per_class",
    """SELECT doc_id, label, seed FROM (
         SELECT doc_id, CAST(l.label AS INTEGER) AS label, CAST(d.seed AS INTEGER) AS seed, row_number() OVER (PARTITION BY l.label, d.seed ORDER BY md5(doc_id || ':' || d.seed), doc_id) AS r
         FROM labelled AS l JOIN (VALUES """ + ", ".join(f"({c}, {s})" for c, s, _ in DRAWS) + """) AS d(label, seed) ON l.label = d.label) AS x WHERE r <= 300""",
)
def l02(t: Tables) -> DataFrame:
    return sampling.sample_per_class(t.labelled().select("doc_id", "label"), "doc_id", "label", DRAWS).select("doc_id", "label", "seed")


@query(
    "l03_rebalance",
    """SELECT doc_id, label FROM (
         SELECT doc_id, CAST(label AS INTEGER) AS label, row_number() OVER (PARTITION BY label ORDER BY md5(doc_id || ':' || CASE label WHEN 2 THEN 25 ELSE 26 END), doc_id) AS r FROM labelled WHERE label IS NOT NULL) AS x
       WHERE label = 0 OR (label = 2 AND r <= 45) OR (label = 1 AND r <= 40)""",
)
def l03(t: Tables) -> DataFrame:
    rows = t.labelled().where("label IS NOT NULL").select("doc_id", "label")
    return sampling.shuffled(sampling.rebalance(rows, "doc_id", "label", {2: (45, 25), 1: (40, 26)}), "doc_id", 50)


@query("l04_attach_labels", "SELECT l.doc_id, l.quality AS label, d.text FROM documents AS d RIGHT JOIN labels AS l ON d.doc_id = l.doc_id")
def l04(t: Tables) -> DataFrame:
    texts = t.table("documents").select("doc_id", "text")
    return texts.join(t.table("labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "right")


@query(
    "l05_stratified_split",
    """SELECT o_orderkey, CASE WHEN r <= ceil(n * 80 / 100.0) THEN 'train' ELSE 'test' END AS split FROM (
         SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || ':0'), o_orderkey) AS r,
                count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) AS x""",
)
def l05(t: Tables) -> DataFrame:
    return sampling.stratified_split(t.table("orders"), "o_orderkey", "o_orderstatus").select("o_orderkey", "split")


# ---- scoring


@query(
    "t11_keyword_weights",
    r"""WITH d AS (SELECT conv_id, replace(string_agg(text, ' ' ORDER BY turn), chr(10), ' ') AS transcript FROM conversations GROUP BY conv_id),
        w AS (SELECT conv_id, unnest(regexp_extract_all(lower(transcript), '[\p{L}\p{N}]+')) AS token FROM d),
        tf AS (SELECT conv_id, token, count(*) AS tf FROM w GROUP BY conv_id, token),
        df AS (SELECT token, count(*) AS df FROM tf GROUP BY token)
        SELECT conv_id, tf.token, tf, df, round(tf * ln(((SELECT count(*) FROM d) + 1) / (df + 1)), 8) AS weight FROM tf JOIN df ON tf.token = df.token""",
)
def t11(t: Tables) -> DataFrame:
    transcripts = joined_segments(t.table("conversations"), ["conv_id"], "turn", "text")
    return rounded(scoring.keyword_weights(transcripts, "conv_id", "transcript"), 8, "weight")


TOKENS = r"unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token"
CLASS_NAME = "CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END"


def bayes_sql(p: str, train: str, asked: str) -> str:
    """CTEs ending in ``{p}guess`` (k, cls): naive Bayes of ``asked`` (k, text) trained on ``train`` (text, cls)."""
    return f"""{p}train AS ({train}), {p}asked AS ({asked}),
      {p}c AS (SELECT cls, token, count(*) AS c FROM (SELECT cls, {TOKENS} FROM {p}train) AS x GROUP BY cls, token),
      {p}v AS (SELECT count(DISTINCT token) AS v FROM {p}c),
      {p}l AS (SELECT cls, ln(count(*) / (SELECT count(*) FROM {p}train)) AS prior FROM {p}train GROUP BY cls),
      {p}u AS (SELECT cls, ln(sum(c) + any_value(v)) AS unit FROM {p}c, {p}v GROUP BY cls),
      {p}w AS (SELECT k, {TOKENS} FROM {p}asked),
      {p}n AS (SELECT a.k, count(token) AS n FROM {p}asked AS a LEFT JOIN {p}w AS w ON a.k = w.k GROUP BY a.k),
      {p}g AS (SELECT k, cls, sum(ln(c + 1)) AS gain FROM {p}w AS w JOIN {p}c AS c ON w.token = c.token GROUP BY k, cls),
      {p}s AS (SELECT n.k, l.cls, prior + coalesce(gain, 0) - n * unit AS score
               FROM {p}n AS n CROSS JOIN {p}l AS l JOIN {p}u AS u ON l.cls = u.cls LEFT JOIN {p}g AS g ON g.k = n.k AND g.cls = l.cls),
      {p}guess AS (SELECT k, cls FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, cls) AS r FROM {p}s) AS x WHERE r = 1)"""


LABELLED_TEXTS = f"SELECT text, {CLASS_NAME} AS cls FROM labelled WHERE label IS NOT NULL"


def sentiment_profile(t: Tables) -> scoring.WordProfile:
    """The built-in classifier, trained on the labelled documents."""
    named = t.labelled().select("text", label_name(F.col("label")).alias("name"))
    return scoring.word_profile(scoring.count_words(named, "text", "name"))


@query(
    "l06_classify_comments",
    "WITH " + bayes_sql("", LABELLED_TEXTS, "SELECT doc_id AS k, text FROM documents") + " SELECT k AS comment_id, cls AS sentiment_label FROM guess",
)
def l06(t: Tables) -> DataFrame:
    docs = t.labelled().select("comment_id", "text")
    return scoring.attach_class(docs, "comment_id", "text", sentiment_profile(t), "sentiment_label").drop("text")


@query(
    "l07_detect_language",
    r"""WITH w AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token FROM documents),
        c AS (SELECT lang, token, count(*) AS c FROM w GROUP BY lang, token),
        l AS (SELECT lang, ln(texts / (SELECT count(*) FROM documents)) AS prior, ln(words + (SELECT count(DISTINCT token) FROM c)) AS unit
              FROM (SELECT lang, sum(c) AS words FROM c GROUP BY lang) AS a JOIN (SELECT lang, count(*) AS texts FROM documents GROUP BY lang) AS b USING (lang)),
        n AS (SELECT doc_id, count(token) AS n FROM documents LEFT JOIN w USING (doc_id) GROUP BY doc_id),
        g AS (SELECT w.doc_id, c.lang, sum(ln(c + 1)) AS gain FROM w JOIN c ON w.token = c.token GROUP BY w.doc_id, c.lang),
        s AS (SELECT n.doc_id, l.lang, prior + coalesce(gain, 0) - n * unit AS score FROM n CROSS JOIN l LEFT JOIN g ON g.doc_id = n.doc_id AND g.lang = l.lang)
        SELECT doc_id, lang AS language FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS r FROM s) AS x WHERE r = 1""",
)
def l07(t: Tables) -> DataFrame:
    docs = t.texts().select("doc_id", "text", "lang")
    profile = scoring.train_language_profile(docs, "text", "lang")
    return scoring.detect_language(docs.select("doc_id", "text"), "doc_id", "text", profile).drop("text")


@query(
    "l08_grid_search",
    f"""WITH parts AS (
          SELECT doc_id, text, label, r <= ceil(n * 80 / 100.0) AS train FROM (
            SELECT doc_id, text, label, row_number() OVER (PARTITION BY label ORDER BY md5(doc_id || ':0'), doc_id) AS r,
                   count(*) OVER (PARTITION BY label) AS n FROM labelled WHERE label IS NOT NULL) AS x),
        grid(setting, smoothing, least) AS (VALUES (0, 0.1::DOUBLE, 1), (1, 0.1, 3), (2, 1.0, 1), (3, 1.0, 3), (4, 10.0, 1), (5, 10.0, 3)),
        c AS (SELECT label, token, count(*) AS c, sum(count(*)) OVER (PARTITION BY token) AS total
              FROM (SELECT label, {TOKENS} FROM parts WHERE train) AS x GROUP BY label, token),
        cg AS (SELECT setting, smoothing, label, token, c FROM c JOIN grid ON total >= least),
        v AS (SELECT setting, count(DISTINCT token) AS v FROM cg GROUP BY setting),
        l AS (SELECT label, ln(count(*) / (SELECT count(*) FROM parts WHERE train)) AS prior FROM parts WHERE train GROUP BY label),
        u AS (SELECT cg.setting, label, any_value(smoothing) AS a, ln(sum(c) + any_value(smoothing) * any_value(v)) AS unit
              FROM cg JOIN v ON cg.setting = v.setting GROUP BY cg.setting, label),
        w AS (SELECT doc_id, {TOKENS} FROM parts WHERE NOT train),
        n AS (SELECT p.doc_id, any_value(p.label) AS actual, count(token) AS n FROM parts AS p LEFT JOIN w ON p.doc_id = w.doc_id WHERE NOT train GROUP BY p.doc_id),
        g AS (SELECT setting, doc_id, label, sum(ln(c + smoothing)) AS gain, count(*) AS met FROM w JOIN cg ON w.token = cg.token GROUP BY setting, doc_id, label),
        s AS (SELECT u.setting, n.doc_id, actual, u.label, prior + coalesce(gain, 0) + (n - coalesce(met, 0)) * ln(a) - n * unit AS score
              FROM n CROSS JOIN u JOIN l ON l.label = u.label LEFT JOIN g ON g.setting = u.setting AND g.doc_id = n.doc_id AND g.label = u.label),
        p AS (SELECT setting, actual, label AS guess FROM (SELECT *, row_number() OVER (PARTITION BY setting, doc_id ORDER BY score DESC, label) AS r FROM s) AS x WHERE r = 1),
        f AS (SELECT setting, k, count(*) FILTER (WHERE actual = k) AS support,
                     coalesce(2.0 * count(*) FILTER (WHERE actual = k AND guess = k)
                              / nullif(count(*) FILTER (WHERE actual = k) + count(*) FILTER (WHERE guess = k), 0), 0) AS f1
              FROM p CROSS JOIN (VALUES (0), (1), (2)) AS classes(k) GROUP BY setting, k),
        m AS (SELECT setting, round(avg(f1), 10) AS macro_f1, round(sum(f1 * support) / sum(support), 10) AS weighted_f1 FROM f GROUP BY setting)
        SELECT m.setting, smoothing, least, macro_f1, weighted_f1, row_number() OVER (ORDER BY macro_f1 DESC, m.setting) = 1 AND macro_f1 > 0 AS best
        FROM m JOIN grid ON m.setting = grid.setting""",
)
def l08(t: Tables) -> DataFrame:
    rows = t.labelled().where("label IS NOT NULL").select("doc_id", "text", "label")
    split = sampling.stratified_split(rows, "doc_id", "label")
    out = scoring.word_grid_search(split.where("split = 'train'"), split.where("split = 'test'"), "doc_id", "text", "label")
    return rounded(out, 10, "macro_f1", "weighted_f1")


SHARE_SQL = """
    WITH latest AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY scraped_at DESC, video_id) AS r FROM comments
                     WHERE scraped_at >= TIMESTAMP '2024-01-05' AND scraped_at < TIMESTAMP '2024-01-20') AS x WHERE r = 1),
    counts AS (SELECT lang, count(*) AS n FROM latest GROUP BY lang),
    running AS (SELECT lang, sum(n) OVER (ORDER BY n DESC, lang ROWS UNBOUNDED PRECEDING) AS cum, sum(n) OVER () AS total FROM counts),
    kept AS (SELECT latest.*, l.label FROM latest JOIN labelled AS l ON latest.doc_id = l.doc_id
             WHERE lang IN (SELECT lang FROM running WHERE cum * 100 <= total * 90))"""


def known_labels(t: Tables):
    """Scorers that look the answer up in the sample, so the rest of the plan can be checked."""
    labels = t.labelled().select("doc_id", F.col("language"), label_name(F.col("label")).alias("sentiment_label"))
    texts = t.comments().select("comment_id", "scraped_at", "doc_id")

    def latest_ids() -> DataFrame:
        seen = texts.where(in_window(F.col("scraped_at"), "2024-01-05 00:00:00", "2024-01-20 00:00:00"))
        return latest_row(seen, ["comment_id"], [F.desc("scraped_at")]).select("comment_id", "doc_id")

    def add_language(df: DataFrame) -> DataFrame:
        return df.join(latest_ids(), "comment_id").join(labels.select("doc_id", "language"), "doc_id").drop("doc_id")

    def add_label(df: DataFrame) -> DataFrame:
        return df.join(latest_ids(), "comment_id").join(labels.select("doc_id", "sentiment_label"), "doc_id").drop("doc_id")

    return add_language, add_label


L9_WINDOW = {"start": "2024-01-05 00:00:00", "end": "2024-01-20 00:00:00"}


@query("l09_latest_comments", SHARE_SQL + " SELECT video_id, comment_id, text FROM latest")
def l09a(t: Tables) -> DataFrame:
    return latest_comments(t.comments(), **L9_WINDOW)


@query(
    "l09_scored_comments",
    SHARE_SQL + """ SELECT video_id, comment_id, text, lang AS language,
        CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END AS sentiment_label FROM kept""",
)
def l09b(t: Tables) -> DataFrame:
    return score_comments(t.comments(), *known_labels(t), **L9_WINDOW, always=["eng_Latn"])


@query(
    "l09_positive_share",
    SHARE_SQL + """ SELECT video_id, round(avg(CASE WHEN label = 2 THEN 1.0 ELSE 0.0 END) * 100, 6) AS positive_sentiment_percentage
        FROM kept GROUP BY video_id""",
)
def l09c(t: Tables) -> DataFrame:
    shares = run_sentiment(t.comments(), *known_labels(t), **L9_WINDOW, always=["eng_Latn"])
    return rounded(shares, 6, "positive_sentiment_percentage")


@query(
    "l09_end_to_end",
    SHARE_SQL[: SHARE_SQL.index("counts AS")] + bayes_sql("lang_", "SELECT text, lang AS cls FROM documents", "SELECT comment_id AS k, text FROM latest")
    + ", " + bayes_sql("tone_", LABELLED_TEXTS, "SELECT comment_id AS k, text FROM latest") + """,
      counts AS (SELECT cls, count(*) AS n FROM lang_guess GROUP BY cls),
      running AS (SELECT cls, sum(n) OVER (ORDER BY n DESC, cls ROWS UNBOUNDED PRECEDING) AS cum, sum(n) OVER () AS total FROM counts)
      SELECT video_id, round(avg(CASE WHEN b.cls = 'positive' THEN 1.0 ELSE 0.0 END) * 100, 6) AS positive_sentiment_percentage
      FROM latest JOIN lang_guess AS a ON comment_id = a.k JOIN tone_guess AS b ON comment_id = b.k
      WHERE a.cls IN (SELECT cls FROM running WHERE cum * 100 <= total * 90) GROUP BY video_id""",
)
def l09d(t: Tables) -> DataFrame:
    """Both built-in scorers, trained on the sample's labels."""
    languages = scoring.train_language_profile(t.texts(), "text", "lang")
    sentiment = sentiment_profile(t)
    shares = run_sentiment(
        t.comments(),
        lambda df: scoring.detect_language(df, "comment_id", "text", languages),
        lambda df: scoring.attach_class(df, "comment_id", "text", sentiment, "sentiment_label"),
        **L9_WINDOW,
    )
    return rounded(shares, 6, "positive_sentiment_percentage")


@query(
    "u2_batched_scorer",
    """SELECT doc_id, CASE WHEN length(coalesce(text, '')) > 2000 THEN 'positive' WHEN length(coalesce(text, '')) > 500 THEN 'neutral' ELSE 'negative' END AS label
       FROM texts_and_nulls""",
)
def u2(t: Tables) -> DataFrame:
    """An external model behind the batched interface: here, a rule on the text length."""

    def load():
        bounds = [(2000, "positive"), (500, "neutral")]

        def predict(texts):
            return [next((name for limit, name in bounds if len(x) > limit), "negative") for x in texts]

        return predict

    scorer = scoring.batch_scorer(load)
    return t.texts_and_nulls().select("doc_id", scorer("text").alias("label"))


# ---- feature table


FEATURES_OUT = """SELECT video_id, title, video_format, content_pillar, publish_year, publish_month, video_age_cohort, video_age_days,
    round(lifetime_engagement_rate, 8) AS lifetime_engagement_rate, round(marginal_engagement_rate, 8) AS marginal_engagement_rate,
    round(daily_view_velocity, 4) AS daily_view_velocity"""


def feature_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "lifetime_engagement_rate": F.round("lifetime_engagement_rate", 8),
            "marginal_engagement_rate": F.round("marginal_engagement_rate", 8),
            "daily_view_velocity": F.round("daily_view_velocity", 4),
        }
    )


@query("l10_feature_table", FEATURES_OUT + " FROM features")
def l10(t: Tables) -> DataFrame:
    return feature_columns(t.features())


@query(
    "l10_feature_table_with_sentiment",
    """WITH s AS (SELECT video_id, round(avg(CASE WHEN label = 2 THEN 1.0 ELSE 0.0 END) * 100, 6) AS positive_sentiment_percentage FROM labelled GROUP BY video_id)
       """ + FEATURES_OUT.replace("SELECT video_id", "SELECT f.video_id") + ", positive_sentiment_percentage FROM features AS f LEFT JOIN s ON f.video_id = s.video_id",
)
def l10b(t: Tables) -> DataFrame:
    scored = t.labelled().withColumn("sentiment_label", label_name(F.col("label")))
    out = make_features(t.snapshots(), t.items(), positive_share(scored), *WINDOW)
    return rounded(feature_columns(out), 6, "positive_sentiment_percentage")


@query(
    "l10_quarantined_formats",
    """SELECT DISTINCT s.video_id, video_format FROM snapshots AS s JOIN (
         SELECT video_id, CASE WHEN description = 'FURNITURE' THEN 'Unknown' ELSE video_format END AS video_format FROM items) AS i ON s.video_id = i.video_id
       WHERE scraped_at >= TIMESTAMP '2024-01-05' AND scraped_at < TIMESTAMP '2024-01-26' AND video_format = 'Unknown'""",
)
def l10c(t: Tables) -> DataFrame:
    unlisted = F.when(F.col("description") == "FURNITURE", "Unknown").otherwise(F.col("video_format"))
    items = t.items().withColumn("video_format", unlisted)
    return quarantined_formats(t.snapshots(), items, *WINDOW).select("video_id", "video_format")


@query(
    "l11_ratio_report",
    """WITH r AS (SELECT video_id, min(scraped_at) AS t0, max(scraped_at) AS t1,
                    max(view_count) FILTER (WHERE up = 1) AS v0, max(view_count) FILTER (WHERE down = 1) AS v1,
                    max(like_count) FILTER (WHERE up = 1) AS l0, max(like_count) FILTER (WHERE down = 1) AS l1
             FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY scraped_at) AS up,
                          row_number() OVER (PARTITION BY video_id ORDER BY scraped_at DESC) AS down FROM snapshots) AS x GROUP BY video_id)
       SELECT r.video_id, title, video_format,
              CASE WHEN datesub('day', published_at, scraped_at) < 30 THEN 'New Release (<30 Days)' WHEN datesub('day', published_at, scraped_at) < 180 THEN 'Recent (1-6 Months)'
                   WHEN datesub('day', published_at, scraped_at) < 720 THEN 'Catalog (6-24 Months)' ELSE 'Legacy (2+ Years)' END AS video_age_days,
              round(CAST(CAST(l1 AS FLOAT) / nullif(CAST(v1 AS FLOAT), 0) AS DOUBLE), 6) AS like_to_view_ratio,
              round(CAST(CAST(l1 - l0 AS FLOAT) / nullif(CAST(v1 - v0 AS FLOAT), 0) AS DOUBLE), 6) AS margin_like_to_view_ratio,
              round(CAST(CAST(v1 - v0 AS FLOAT) AS DOUBLE) / nullif((epoch_us(t1) - epoch_us(t0)) / 86400000000.0, 0), 4) AS daily_view_velocity
       FROM r JOIN items AS i ON r.video_id = i.video_id ORDER BY published_at, r.video_id LIMIT 50""",
)
def l11(t: Tables) -> DataFrame:
    return ratio_report(t.snapshots(), t.items()).withColumns(
        {
            "like_to_view_ratio": F.round(F.col("like_to_view_ratio").cast("double"), 6),
            "margin_like_to_view_ratio": F.round(F.col("margin_like_to_view_ratio").cast("double"), 6),
            "daily_view_velocity": F.round("daily_view_velocity", 4),
        }
    )
