"""Text scoring: keyword weights, language detection, sentiment classification, grid search."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewright.functions.rates import argmax
from tidewright.functions.text import flatten_lines, label_name, words
from tidewright.operators.evaluation import cell_counts, class_scores, full_matrix, overall_scores
from tidewright.operators.frames import concat_frames
from tidewright.operators.hotkeys import attach_counted
from tidewright.session import cut_lineage

# Settings of a grid fitted at the same time; the fits share one materialised input.
PARALLEL_FITS = 3


def keyword_weights(df: DataFrame, key: str, text: str) -> DataFrame:
    """TF-IDF weight of every word of every text, idf = ln((N + 1) / (df + 1)).

    A word found in most texts is attached without shuffling its rows.
    """
    tf = cut_lineage(
        df.select(key, F.explode(words(F.col(text))).alias("token"))
        .groupBy(key, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    df_counts = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    rows = attach_counted(tf, df_counts, ["token"], "df")
    return rows.select(
        key, "token", "tf", "df", (F.col("tf") * F.ln((n_docs + 1) / (F.col("df") + 1))).alias("weight")
    )


@dataclass(frozen=True)
class WordCounts:
    """Training counts of (class, token), stored, and the number of texts per class."""

    counts: DataFrame
    texts: DataFrame


@dataclass(frozen=True)
class WordProfile:
    """Multinomial naive Bayes over words. ``gains`` has one row per token with
    ln((count + smoothing) / smoothing) for every class in ``classes``."""

    gains: DataFrame
    classes: list
    priors: list[float]
    units: list[float]


def count_words(df: DataFrame, text: str, label: str) -> WordCounts:
    """Null labels are a class of no text and leave the training set."""
    given = df.where(F.col(label).isNotNull()).select(F.col(label).alias("class"), words(F.col(text)).alias("tokens"))
    counts = given.select("class", F.explode("tokens").alias("token")).groupBy("class", "token").agg(F.count(F.lit(1)).alias("c"))
    texts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("texts"))
    return WordCounts(cut_lineage(counts), cut_lineage(texts))


def word_profile(trained: WordCounts, smoothing: float = 1.0, least: int = 1) -> WordProfile:
    """The model with words that occur at least ``least`` times; others weigh like unseen ones.

    One row per class reaches the driver: the classes become columns of the scoring plan.
    """
    counts = trained.counts
    if least > 1:
        common = counts.groupBy("token").agg(F.sum("c").alias("n")).where(F.col("n") >= least)
        counts = counts.join(common.select("token"), "token")
    vocabulary = counts.select("token").distinct().count()
    per_class = (
        counts.groupBy("class").agg(F.sum("c").alias("words")).join(trained.texts, "class").orderBy("class").collect()
    )
    classes = [r["class"] for r in per_class]
    texts = trained.texts.agg(F.sum("texts")).first()[0]
    of_class = [F.sum(F.when(F.col("class") == F.lit(name), F.col("c")).otherwise(0)) for name in classes]
    gains = counts.groupBy("token").agg(F.array(*[F.ln(n / F.lit(smoothing) + 1) for n in of_class]).alias("gains"))
    return WordProfile(
        gains=cut_lineage(gains),
        classes=classes,
        priors=[math.log(r["texts"] / texts) for r in per_class],
        units=[math.log(r["words"] / smoothing + vocabulary) for r in per_class],
    )


def train_language_profile(df: DataFrame, text: str, language: str) -> WordProfile:
    return word_profile(count_words(df, text, language))


def attach_class(df: DataFrame, key: str, text: str, profile: WordProfile, name: str) -> DataFrame:
    """Adds ``name``, the most likely class of the flattened text; ``key`` is unique in ``df``.

    Words are shuffled to the profile and probe a hash table of their part of it. They are never sorted: a task's
    memory follows the vocabulary of its part, not the words that reach it. The sums are combined map-side.
    """
    tokens = df.select(key, F.explode_outer(words(flatten_lines(F.col(text)))).alias("token"))
    width = range(len(profile.classes))
    sums = (
        tokens.join(profile.gains.hint("shuffle_hash"), "token", "left")
        .groupBy(key)
        .agg(F.count("token").alias("n"), *[F.coalesce(F.sum(F.col("gains")[i]), F.lit(0.0)).alias(f"g{i}") for i in width])
    )
    scores = F.array(
        *[F.lit(profile.priors[i]) + F.col(f"g{i}") - F.col("n") * F.lit(profile.units[i]) for i in width]
    )
    names = F.array(*[F.lit(c) for c in profile.classes])
    chosen = sums.select(key, scores.alias("_scores")).select(
        key, F.element_at(names, argmax(F.col("_scores")) + 1).alias(name)
    )
    return df.join(chosen, key)


def detect_language(df: DataFrame, key: str, text: str, profile: WordProfile) -> DataFrame:
    """Adds ``language``, the most likely one for the flattened text."""
    return attach_class(df, key, text, profile, "language")


def batch_scorer(load: Callable[[], Callable[[list[str]], list[str]]], batch: int = 64):
    """Wrap an external model as an Arrow-batched scorer.

    ``load`` runs once per worker and returns a function from a list of texts to labels; null texts
    arrive as empty strings, ``batch`` texts at a time.
    """

    @F.pandas_udf(StringType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for texts in batches:
            values = texts.fillna("").astype(str).tolist()
            labels: list[str] = []
            for start in range(0, len(values), batch):
                labels.extend(predict(values[start : start + batch]))
            yield pd.Series(labels, dtype="object")

    return score


def _text_stages(features: int) -> list:
    return [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_features"),
    ]


def _classifier(label: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="_features", labelCol=label, predictionCol="_prediction",
        rawPredictionCol="_raw", probabilityCol="_probability", family="multinomial",
    )


def _with_text(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))


def train_sentiment(
    df: DataFrame, text: str, label: str, reg: float = 0.01, max_iter: int = 20, features: int = 1 << 14
) -> PipelineModel:
    """Hashed TF-IDF with multinomial logistic regression on a labelled sample (labels 0, 1, 2).
    The model size is fixed by ``features``, whatever the vocabulary. The vectors are materialised
    once: every iteration of the fit reads them."""
    stages = Pipeline(stages=_text_stages(features)).fit(_with_text(df, text))
    vectors = cut_lineage(stages.transform(_with_text(df, text)).select(label, "_features"))
    fit = _classifier(label).setRegParam(reg).setMaxIter(max_iter).fit(vectors)
    return PipelineModel(stages=stages.stages + [fit])


def classify(df: DataFrame, text: str, model: PipelineModel) -> DataFrame:
    """Adds ``sentiment_label``."""
    scored = model.transform(_with_text(df, text))
    return scored.select(*df.columns, label_name(F.col("_prediction").cast("int")).alias("sentiment_label"))


def grid_search(
    train: DataFrame,
    test: DataFrame,
    text: str,
    label: str,
    regs: Sequence[float] = (0.1, 0.01, 0.001),
    iterations: Sequence[int] = (5, 10, 20),
    features: int = 1 << 14,
) -> DataFrame:
    """Macro and weighted F1 of every setting on the test part, with ``best`` marking the first
    setting whose macro F1 is strictly above all before it.

    The text features are built once and shared; the fits then run over the materialised vectors.
    """
    stages = Pipeline(stages=_text_stages(features)).fit(_with_text(train, text))
    columns = [label, "_features"]
    fit_on = cut_lineage(stages.transform(_with_text(train, text)).select(*columns))
    test_on = cut_lineage(stages.transform(_with_text(test, text)).select(*columns))
    grid = [(reg, n) for reg in regs for n in iterations]
    base = _classifier(label)
    settings = [{base.regParam: reg, base.maxIter: n} for reg, n in grid]
    with ThreadPool(PARALLEL_FITS) as pool:
        fits = base.fitMultiple(fit_on, settings)
        models = dict(pool.imap_unordered(lambda _: next(fits), settings))
    # One job scores the test part with every model; all settings are then evaluated together.
    cells = concat_frames(
        [
            cell_counts(models[i].transform(test_on), label, "_prediction").withColumn("setting", F.lit(i))
            for i in range(len(grid))
        ]
    )
    return _ranked(cells, models[0].numClasses, {"reg": [g[0] for g in grid], "max_iter": [g[1] for g in grid]})


def word_grid_search(
    train: DataFrame,
    test: DataFrame,
    key: str,
    text: str,
    label: str,
    smoothings: Sequence[float] = (0.1, 1.0, 10.0),
    leasts: Sequence[int] = (1, 3),
    classes: int = 3,
) -> DataFrame:
    """As ``grid_search``, for the word model: the training words are counted once for all settings."""
    trained = count_words(train, text, label)
    grid = [(s, n) for s in smoothings for n in leasts]
    asked = test.where(F.col(label).isNotNull()).select(key, text, label)
    cells = concat_frames(
        [
            cell_counts(attach_class(asked, key, text, word_profile(trained, s, n), "_prediction"), label, "_prediction")
            .withColumn("setting", F.lit(i))
            for i, (s, n) in enumerate(grid)
        ]
    )
    return _ranked(cells, classes, {"smoothing": [g[0] for g in grid], "least": [g[1] for g in grid]})


def _ranked(cells: DataFrame, classes: int, settings: dict[str, list]) -> DataFrame:
    """Scores of every setting with the winner marked."""
    by = ["setting"]
    scores = overall_scores(class_scores(full_matrix(cut_lineage(cells), classes, by), by), by)
    out = scores.select(
        "setting",
        *[F.array(*[F.lit(v) for v in values])[F.col("setting")].alias(name) for name, values in settings.items()],
        "macro_f1", "weighted_f1",
    )
    # Highest macro F1, earliest setting on ties, and only if above 0: one row per setting.
    out = cut_lineage(out)
    winner = out.where("macro_f1 > 0").agg(F.min_by("setting", F.struct(-F.col("macro_f1"), "setting"))).scalar()
    return out.withColumn("best", F.coalesce(F.col("setting") == winner, F.lit(False)))
