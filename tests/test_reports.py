"""Model audit, transcript runs and group reports on small tables."""

import pytest
from pyspark.sql import functions as F

from tidewright.plans import groups
from tidewright.plans.model import audit_model, with_model_defaults
from tidewright.plans.transform import transform_transcripts
from tidewright.schemas import COMMENTS, FAILED_FETCH, SNIPPETS, STATS, TRANSCRIPTS
from tidewright.sources.tables import read_table


def violations(tables):
    return {(r.table_name, r.rule, r.columns): r.violations for r in audit_model(tables).collect()}


def test_audit_counts_every_kind_of_violation(spark):
    snippets = spark.createDataFrame(
        [("a", "Short", "t"), ("a", "Clip", None), ("b", None, "t"), (None, "Short", "t")], "video_id string, video_format string, title string"
    ).withColumn("published_at", F.lit(None).cast("timestamp"))
    stats = spark.createDataFrame([("a", 1, None), ("a", 1, 5), ("z", 2, 5), (None, 3, 5)], "video_id string, scraped_at int, view_count long").withColumns(
        {"like_count": F.lit(1), "comment_count": F.lit(None).cast("int")}
    )
    got = violations({"snippets": snippets, "stats": stats})
    assert got["snippets", "primary_key", "video_id"] == 1
    assert got["snippets", "not_null", "video_id"] == 1 and got["snippets", "not_null", "published_at"] == 4
    assert got["snippets", "not_null", "title"] == 1 and got["snippets", "domain", "video_format"] == 1
    assert got["stats", "primary_key", "video_id,scraped_at"] == 1
    assert got["stats", "foreign_key", "video_id"] == 1
    assert got["stats", "default", "view_count"] == 1 and got["stats", "default", "comment_count"] == 4
    assert violations({"stats": stats}).keys() == {k for k in got if k[0] == "stats" and k[1] != "foreign_key"}
    assert with_model_defaults("stats", stats).where("view_count = 0 AND comment_count = 0").count() == 1


def test_audit_of_empty_tables_finds_nothing(spark):
    empty = {name: spark.createDataFrame([], s) for name, s in (("snippets", SNIPPETS), ("stats", STATS), ("comments", COMMENTS), ("transcripts", TRANSCRIPTS))}
    assert set(violations(empty).values()) == {0}


def test_transcript_runs_ask_again_only_for_failed_fetches(spark, tmp_path):
    path = str(tmp_path / "transcripts")
    rows = [("a", "Long-form"), ("b", "Live/VOD"), ("c", "Long-form"), ("d", "Short"), ("e", None)]
    snippets = spark.createDataFrame(rows, "video_id string, video_format string")
    asked = []

    def fetch(said):
        def attempts(ids):
            asked.append(sorted(r.video_id for r in ids.collect()))
            answer = F.create_map(*[x for k, v in said.items() for x in (F.lit(k), F.lit(v).cast("string"))])
            return ids.withColumn("transcript", answer[F.col("video_id")])

        return attempts

    first = transform_transcripts(spark, snippets, path, fetch({"a": "one", "b": FAILED_FETCH, "c": None}))
    assert (first.batch_id, first.written, first.unavailable) == (0, 2, 1)
    for _ in range(2):
        again = transform_transcripts(spark, snippets, path, fetch({"b": "two"}), batch_id=1)
        assert (again.written, again.unavailable) == (1, 0)
    assert asked == [["a", "b", "c"], ["b"], ["b"]]
    last = transform_transcripts(spark, snippets, path, fetch({"b": "three"}))
    assert last.written == 0 and asked[-1] == []
    assert {(r.video_id, r.transcript) for r in read_table(spark, path, TRANSCRIPTS).collect()} == {("a", "one"), ("b", "two"), ("c", None)}


def test_transcript_runs_keep_to_their_limit(spark, tmp_path):
    snippets = spark.range(100).selectExpr("concat('v', id) AS video_id", "'Long-form' AS video_format")
    done = transform_transcripts(spark, snippets, str(tmp_path / "t"), lambda ids: ids.withColumn("transcript", F.lit("x")), limit=7)
    assert done.written == 7
    assert transform_transcripts(spark, snippets, str(tmp_path / "t"), lambda ids: ids.withColumn("transcript", F.lit("x")), limit=None).written == 93


def test_group_reports_on_few_values(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", 10.0), ("b", 12.0), ("b", 14.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "grp string, x double")
    assert {r.grp: (r.n, r.median) for r in groups.group_levels(df, "x", "grp").collect()} == {"a": (2, 2.0), "b": (3, 12.0)}
    kruskal = groups.difference_tests(df, "x", "grp").where("test_name = 'kruskal'").first()
    assert kruskal.stat == pytest.approx(3.0) and kruskal.differs is False
    pair = groups.level_pairs(df, "x", "grp").first()
    assert (pair.group_a, pair.group_b, pair.same) == ("a", "b", True)
    one = groups.difference_tests(df.where("grp = 'a'"), "x", "grp").collect()
    assert {r.differs for r in one} == {None}
