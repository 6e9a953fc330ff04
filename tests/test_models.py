from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tidewright.operators import evaluation, frames, sampling, scoring
from tidewright.plans.features import make_features
from tidewright.plans.sentiment import keep_frequent_languages, run_sentiment


def test_sample_is_exact_and_partition_independent(spark, rows):
    df = spark.range(2000).withColumnRenamed("id", "k")
    one = sampling.sample_rows(df.repartition(7), "k", 384, 8)
    assert one.count() == 384
    assert rows(one) == rows(sampling.sample_rows(df.orderBy(F.desc("k")), "k", 384, 8))
    assert rows(one) != rows(sampling.sample_rows(df, "k", 384, 9))
    assert sampling.sample_rows(df.limit(10), "k", 384, 8).count() == 10
    assert sampling.sample_size() == 384


def test_class_draws_agree_with_a_ranked_window(spark, rows):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("label"))
    draws = [(0, 1, 300), (0, 2, 300), (2, 1, 2000)]
    got = rows(sampling.sample_per_class(df, "k", "label", draws), "k", "label", "seed")
    keys = {0: range(0, 3000, 3), 2: range(2, 3000, 3)}
    want = [
        (k, label, seed)
        for label, seed, n in draws
        for k in sorted(keys[label], key=lambda k: md5(f"{k}:{seed}".encode()).hexdigest())[:n]
    ]
    assert sorted(got) == sorted(want) and len(want) == 300 + 300 + 1000


def test_rebalance(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") < 800, 2).when(F.col("id") < 950, 1).otherwise(0).alias("label"))
    got = {r["label"]: r["count"] for r in sampling.rebalance(df, "k", "label", {2: (450, 25), 1: (400, 26)}).groupBy("label").count().collect()}
    assert got == {2: 450, 1: 150, 0: 50}


def test_split_is_stratified(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), F.when(F.col("id") < 990, "a").otherwise("b").alias("label"))
    out = sampling.stratified_split(df, "k", "label")
    got = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert got == {("a", "train"): 792, ("a", "test"): 198, ("b", "train"): 11, ("b", "test"): 2}


def labelled(spark, *pairs):
    return spark.createDataFrame(list(pairs), "y int, p int")


def test_error_rate_counts_missing_predictions(spark):
    df = labelled(spark, (0, 0), (1, 2), (2, None), (None, None))
    row = evaluation.error_rate(df, "y", "p").first()
    assert (row["n"], row["n_wrong"], row["error_rate"]) == (4, 3, 0.75)
    assert evaluation.misclassified(df, "y", "p").count() == 3


def test_scores_with_absent_classes(spark):
    df = labelled(spark, (0, 0), (0, 1), (1, 1), (1, 1))
    scores = {r["class"]: r for r in evaluation.class_scores(evaluation.confusion_matrix(df, "y", "p")).collect()}
    assert (scores[2]["support"], scores[2]["f1"]) == (0, 0.0)
    assert scores[0]["precision"] == 1.0 and scores[0]["recall"] == 0.5
    overall = evaluation.evaluate(df, "y", "p").first()
    f0, f1 = 2 / 3, 0.8
    assert overall["accuracy"] == 0.75
    assert overall["macro_f1"] == pytest.approx((f0 + f1) / 3)
    assert overall["weighted_f1"] == pytest.approx((f0 + f1) / 2)


def test_literal_frames(spark, rows):
    assert rows(frames.value_list(spark, ["a", "b"], "x")) == [("a",), ("b",)]


def docs(spark):
    texts = [("en", "the cat sat on the mat"), ("en", "the dog and the bird"), ("de", "der hund und die katze"), ("de", "das ist der vogel")]
    return spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(texts * 3)], "k int, lang string, text string")


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_language_detection_paths_agree(spark, rows, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    profile = scoring.train_language_profile(docs(spark), "text", "lang")
    asked = spark.createDataFrame([(1, "the bird\nsat"), (2, "die katze ist"), (3, None), (4, "zzz")], "k int, text string")
    try:
        got = {r["k"]: r["language"] for r in scoring.detect_language(asked, "k", "text", profile).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Unknown words weigh against the language with more training words; ties go to the first.
    assert got[1] == "en" and got[2] == "de" and set(got) == {1, 2, 3, 4}


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_words_meet_the_profile_without_being_sorted(spark, limit):
    """A sort of all words would hold a share of them that grows with the texts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        asked = spark.createDataFrame([(i, "the " * 50 + ("bird", "katze")[i % 2]) for i in range(200)] + [(200, None)], "k int, text string")
        out = scoring.detect_language(asked, "k", "text", scoring.train_language_profile(docs(spark), "text", "lang"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r["k"]: r["language"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin [token" in plan and "Sort [token" not in plan
    assert set(got) == set(range(201)) and {got[i] for i in range(200)} == {"en"}


def test_keyword_weights(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "a c"), (3, None)], "k int, text string")
    got = {(r["k"], r["token"]): (r["tf"], r["df"], round(r["weight"], 6)) for r in scoring.keyword_weights(df, "k", "text").collect()}
    assert got == {(1, "a"): (1, 2, 0.287682), (1, "b"): (2, 1, 1.386294), (2, "a"): (1, 2, 0.287682), (2, "c"): (1, 1, 0.693147)}


def test_classifier_learns_and_scores_null_text(spark):
    data = [(i, "great love" if i % 3 == 2 else "okay fine" if i % 3 == 1 else "bad hate", i % 3) for i in range(60)] + [(99, None, 1)]
    df = spark.createDataFrame(data, "k int, text string, label int")
    model = scoring.train_sentiment(df, "text", "label", features=256)
    got = {r["k"]: r["sentiment_label"] for r in scoring.classify(df, "text", model).collect()}
    assert (got[0], got[1], got[2]) == ("negative", "neutral", "positive") and got[99] is not None


def test_grid_search_marks_one_best(spark):
    data = [(i, "great love" if i % 3 == 2 else "okay fine" if i % 3 == 1 else "bad hate", i % 3) for i in range(60)]
    df = spark.createDataFrame(data, "k int, text string, label int")
    out = scoring.grid_search(df, df, "text", "label", regs=(0.1, 0.01), iterations=(2, 5), features=128).collect()
    best = max(r["macro_f1"] for r in out)
    assert [r["setting"] for r in out if r["best"]] == [min(r["setting"] for r in out if r["macro_f1"] == best)]


def test_word_model_settings(spark):
    data = [(i, "great love" if i % 3 == 2 else "okay fine" if i % 3 == 1 else "bad hate", i % 3) for i in range(30)] + [(98, "rare", None), (99, None, 1)]
    df = spark.createDataFrame(data, "k int, text string, label int")
    trained = scoring.count_words(df, "text", "label")
    assert trained.counts.where("token = 'rare'").isEmpty()
    got = {r["k"]: r["c"] for r in scoring.attach_class(df, "k", "text", scoring.word_profile(trained, 0.5, 3), "c").collect()}
    # Without known words the most frequent class wins.
    assert (got[0], got[1], got[2], got[99]) == (0, 1, 2, 1)
    out = scoring.word_grid_search(df, df, "k", "text", "label", (0.1, 1.0), (1, 3)).collect()
    assert [r["setting"] for r in out if r["best"]] == [0] and {r["macro_f1"] for r in out} == {1.0}


def test_batched_scorer_gets_no_nulls(spark, rows):
    def load():
        return lambda texts: [f"{len(texts) <= 2}:{len(t)}" for t in texts]

    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "k int, text string").coalesce(1)
    scorer = scoring.batch_scorer(load, batch=2)
    assert rows(df.select("k", scorer("text").alias("x"))) == [(1, "True:3"), (2, "True:0"), (3, "True:0")]


def test_sentiment_pipeline(spark, rows):
    comments = spark.createDataFrame(
        [
            ("c1", "v1", "old", "2024-01-01 00:00:00"), ("c1", "v1", "new", "2024-01-02 00:00:00"),
            ("c2", "v1", "bad", "2024-01-02 00:00:00"), ("c3", "v2", "rare", "2024-01-02 00:00:00"), ("c4", "v2", "new", "2024-02-01 00:00:00"),
        ],
        "comment_id string, video_id string, text string, scraped_at string",
    ).withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    shares = run_sentiment(
        comments,
        lambda df: df.withColumn("language", F.when(F.col("text") == "rare", "xx").otherwise("eng_Latn")),
        lambda df: df.withColumn("sentiment_label", F.when(F.col("text") == "bad", "negative").otherwise("positive")),
        start="2024-01-01 00:00:00", end="2024-01-31 00:00:00",
    )
    assert rows(shares) == [("v1", 50.0)]


def test_frequent_languages_join_the_fixed_list(spark):
    df = spark.createDataFrame([(x,) for x in ["k"] * 6 + ["j"] * 2 + ["spa_Latn"] + ["zz"]], "language string")
    got = sorted(r[0] for r in keep_frequent_languages(df).distinct().collect())
    assert got == ["j", "k", "spa_Latn"]


def feature_inputs(spark, video_format="Short"):
    stats = spark.createDataFrame(
        [
            ("a", "2026-05-17 00:00:00", 100, 10, 1), ("a", "2026-06-15 23:59:59", 300, 6, 5), ("a", "2026-06-16 00:00:00", 999, 999, 999),
            ("a", "2026-05-16 23:59:59", 1, 1, 1), ("one", "2026-06-01 00:00:00", 0, 0, 0), ("lost", "2026-06-01 00:00:00", 4, 1, 1),
        ],
        "video_id string, scraped_at string, view_count long, like_count long, comment_count long",
    ).withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    snippets = spark.createDataFrame(
        [("a", "락 challenge", video_format, "2026-05-16 23:59:59"), ("one", "x", "Live/VOD", "2024-01-01 00:00:00")],
        "video_id string, title string, video_format string, published_at string",
    ).withColumn("published_at", F.col("published_at").cast("timestamp"))
    sentiment = spark.createDataFrame([("a", 75.0)], "video_id string, positive_sentiment_percentage double")
    return stats, snippets, sentiment


def test_feature_table(spark):
    out = make_features(*feature_inputs(spark))
    assert len(out.columns) == 12
    got = {r["video_id"]: r for r in out.collect()}
    a = got["a"]
    assert a["content_pillar"] == "ROCK-STAR Era"
    assert (a["publish_year"], a["publish_month"]) == (2026, 5)
    assert (a["video_age_days"], a["video_age_cohort"]) == (30, "Recent (1-6 Months)")
    assert a["lifetime_engagement_rate"] == pytest.approx(11 / 300)
    assert a["marginal_engagement_rate"] == 0.0
    assert a["daily_view_velocity"] == pytest.approx(200 / (30 - 1 / 86400))
    assert a["positive_sentiment_percentage"] == 75.0
    one = got["one"]
    assert one["lifetime_engagement_rate"] is one["marginal_engagement_rate"] is one["daily_view_velocity"] is None
    lost = got["lost"]
    assert (lost["title"], lost["content_pillar"], lost["video_age_cohort"], lost["video_age_days"]) == (None, None, "Legacy (2+ Years)", None)


def test_unknown_format_raises_or_is_dropped(spark):
    stats, snippets, sentiment = feature_inputs(spark, "Unknown")
    with pytest.raises(Exception, match="outside its domain"):
        make_features(stats, snippets, sentiment).collect()
    assert {r["video_id"] for r in make_features(stats, snippets, sentiment, on_bad_format="drop").collect()} == {"one", "lost"}
