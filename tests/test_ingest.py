import json

import pytest
from pyspark.sql import functions as F

from tidewright.operators import ingest, integrity
from tidewright.plans.landing import land_run
from tidewright.schemas import RAW_COMMENTS, RAW_VIDEOS, REGISTRY, SNIPPETS, STATS
from tidewright.session import fresh_path
from tidewright.sources import files, tables


def videos(spark, *batches):
    data = [(stamp, json.dumps(payload)) for stamp, payload in batches]
    return spark.createDataFrame(data, "scraped_at string, video_response string").withColumn(
        "scraped_at", F.col("scraped_at").cast("timestamp")
    )


def item(vid, title="t", **more):
    return {"id": vid, "snippet": {"title": title, "publishedAt": "2024-01-01T00:00:00Z", **more.pop("snippet", {})}, **more}


def registry(spark, **formats):
    return spark.createDataFrame(list(formats.items()) or [("none", "x")], "video_id string, video_format string")


def test_flatten_defaults(spark):
    raw = videos(
        spark,
        ("2024-01-02", {"items": [item("a", statistics={"viewCount": "12"}, snippet={"tags": ["x", "y"]}), item("b")]}),
        ("2024-01-03", {"kind": "empty"}),
    )
    stats = {r["video_id"]: r for r in ingest.flatten_stats(raw).collect()}
    assert (stats["a"]["view_count"], stats["a"]["like_count"]) == (12, 0)
    assert (stats["b"]["view_count"], stats["b"]["comment_count"]) == (0, 0)
    rows = {r["video_id"]: r for r in ingest.flatten_snippets(raw, registry(spark, a="Short")).collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"]["video_format"], rows["a"]["tags"]) == ("Short", "x,y")
    assert (rows["b"]["video_format"], rows["b"]["tags"], rows["b"]["description"]) == ("Unknown", "", None)
    assert rows["b"]["video_link"].endswith("watch?v=b")


def test_flatten_comments_defaults(spark):
    payload = {"items": [{"id": "c1", "snippet": {"topLevelComment": {"snippet": {"publishedAt": "2024-01-01T01:00:00Z"}}}}]}
    raw = spark.createDataFrame(
        [("v", "2024-01-02", json.dumps(payload)), ("w", "2024-01-02", "{}")],
        "video_id string, scraped_at string, comment_response string",
    )
    got = ingest.flatten_comments(raw).collect()
    assert [(r["comment_id"], r["author"], r["text"], r["like_count"]) for r in got] == [("c1", "Unknown", "", 0)]


def test_malformed_counter_raises(spark):
    raw = videos(spark, ("2024-01-02", {"items": [item("a", statistics={"viewCount": "many"})]}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest.flatten_stats(raw).collect()


def snippet_rows(spark, *data):
    rows = [(v, "2024-01-01", f, t, None, None, "", "l", s) for v, f, t, s in data]
    text = ", ".join(f"{n} string" for n in SNIPPETS.fieldNames())
    df = spark.createDataFrame(rows, text)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("published_at", "scraped_at")})


def test_upsert_keeps_first_and_overwrites_last(spark):
    existing = snippet_rows(spark, ("a", "Short", "old", "2024-01-05"))
    incoming = snippet_rows(
        spark, ("a", "Unknown", "new", "2024-01-06"), ("b", "Long-form", "first", "2024-01-06"), ("b", "Short", "second", "2024-01-07")
    ).withColumn("position", F.lit(0))
    got = {r["video_id"]: r for r in ingest.upsert_snippets(existing, incoming).collect()}
    assert (got["a"]["video_format"], got["a"]["title"]) == ("Short", "new")
    assert (got["b"]["video_format"], got["b"]["title"]) == ("Long-form", "second")
    assert str(got["b"]["scraped_at"]) == "2024-01-07 00:00:00"


def test_upsert_breaks_ties_by_position(spark):
    incoming = snippet_rows(spark, ("a", "x", "one", "2024-01-06"), ("a", "y", "two", "2024-01-06")).withColumn(
        "position", F.when(F.col("title") == "one", 3).otherwise(1)
    )
    row = ingest.upsert_snippets(spark.createDataFrame([], SNIPPETS), incoming).first()
    assert (row["video_format"], row["title"]) == ("y", "one")


def stats_rows(spark, *data):
    df = spark.createDataFrame([(v, s, n, 0, 0) for v, s, n in data], "video_id string, scraped_at string, view_count long, like_count long, comment_count long")
    return df.withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))


KEY = ["video_id", "scraped_at"]


def test_append_is_one_transaction(spark, rows):
    path = fresh_path(spark, "t")
    assert tables.append_records(spark, stats_rows(spark, ("a", "2024-01-01", 1)), path, STATS, KEY).written == 1
    both = stats_rows(spark, ("a", "2024-01-01", 2), ("b", "2024-01-01", 3))
    rejected = tables.append_records(spark, both, path, STATS, KEY)
    assert (rejected.written, rejected.conflicts) == (0, 1)
    skipped = tables.append_records(spark, both, path, STATS, KEY, on_conflict="skip")
    assert (skipped.written, skipped.conflicts) == (1, 1)
    repeated = stats_rows(spark, ("c", "2024-01-01", 2), ("c", "2024-01-01", 3))
    assert tables.append_records(spark, repeated, path, STATS, KEY).written == 0
    assert tables.append_records(spark, spark.createDataFrame([], STATS), path, STATS, KEY).written == 0
    assert rows(tables.read_table(spark, path, STATS), "video_id", "view_count") == [("a", 1), ("b", 3)]


def test_a_retried_append_replaces_itself(spark, rows):
    path = fresh_path(spark, "append")
    first, second = stats_rows(spark, ("a", "2024-01-01", 1)), stats_rows(spark, ("b", "2024-01-01", 2), ("c", "2024-01-02", 3))
    for batch, name in ((first, "one"), (second, "two"), (second, "two"), (first, "one")):
        done = tables.append_records(spark, batch, path, STATS, KEY, batch_id=name)
        assert (done.written, done.conflicts) == (batch.count(), 0)
    assert rows(tables.read_table(spark, path, STATS), "video_id") == [("a",), ("b",), ("c",)]
    # Another run with the same rows, under its own name, is turned away.
    assert tables.append_records(spark, second, path, STATS, KEY, batch_id="three").conflicts == 2
    shorter = tables.append_records(spark, second.limit(0), path, STATS, KEY, batch_id="two")
    assert shorter.written == 0 and rows(tables.read_table(spark, path, STATS), "video_id") == [("a",)]


def test_a_transform_run_takes_what_is_new_and_retries_in_place(spark, rows):
    from tidewright.plans.transform import transform_stats

    def raw(*days):
        payload = '{"items": [{"id": "v%s", "statistics": {"viewCount": "7"}}]}'
        return spark.createDataFrame([(f"2024-01-{d}", payload % d) for d in days], "d string, video_response string").select(
            F.col("d").cast("timestamp").alias("scraped_at"), "video_response"
        )

    path = fresh_path(spark, "stats")
    assert transform_stats(spark, raw("02"), path).written == 1
    assert transform_stats(spark, raw("01", "02", "03"), path, 1).written == 1
    # The retry sees one payload more, as a late attempt would.
    assert transform_stats(spark, raw("01", "02", "03", "04"), path, 1).written == 2
    assert transform_stats(spark, raw("02", "03", "04"), path).written == 0
    assert rows(tables.read_table(spark, path, STATS), "video_id", "view_count") == [("v02", 7), ("v03", 7), ("v04", 7)]


def test_admitted_plans(spark, rows):
    old, new = stats_rows(spark, ("a", "2024-01-01", 1)), stats_rows(spark, ("a", "2024-01-01", 2), ("b", "2024-01-01", 3))
    assert ingest.admitted(new, old, KEY).count() == 0
    assert ingest.admitted(new, None, KEY).count() == 2
    assert rows(ingest.admitted(new, old, KEY, "skip"), "video_id") == [("b",)]


def test_nested_values_are_stored_as_json(spark):
    df = spark.createDataFrame([(1, {"a": None}, ["x"])], "i int, m map<string,string>, l array<string>")
    row = ingest.nested_to_json(df).first()
    assert (row["m"], row["l"]) == ('{"a":null}', '["x"]')


def test_mark_is_strict_and_late_rows_are_lost(spark, rows):
    source = stats_rows(spark, ("late", "2024-01-01", 1), ("at", "2024-01-02", 1), ("after", "2024-01-03", 1))
    target = stats_rows(spark, ("x", "2024-01-02", 1))
    assert rows(ingest.rows_after_mark(source, target, "scraped_at"), "video_id") == [("after",)]
    assert ingest.rows_after_mark(source, target.limit(0), "scraped_at").count() == 3
    assert ingest.rows_after_mark(source, None, "scraped_at").count() == 3


def test_id_batches(spark):
    ids = spark.range(120).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("video_id"))
    got = {r["batch"]: r["ids"] for r in ingest.id_batches(ids, "video_id", ["video_id"]).collect()}
    assert [len(got[b]) for b in sorted(got)] == [50, 50, 20]
    assert got[1][0] == "v050" and got[2][-1] == "v119"


def test_registry_keeps_last_format_of_a_repeated_id(spark, rows):
    current = spark.createDataFrame([("a", "Long-form", 1), ("a", "Live/VOD", 2), ("b", "Short", 3)], "video_id string, video_format string, pos int")
    got = ingest.new_registry_rows(current, registry(spark, b="Short"), F.lit("2024-01-01").cast("timestamp"), "pos")
    assert rows(got, "video_id", "video_format") == [("a", "Live/VOD")]


def test_transcript_work_list(spark):
    snippets = spark.range(100).select(
        F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("video_id"),
        F.when(F.col("id") % 2 == 0, "Long-form").otherwise("Short").alias("video_format"),
    )
    done = spark.createDataFrame([("v000", None)], "video_id string, transcript string")
    got = [r[0] for r in ingest.missing_transcripts(snippets, done, 500).collect()]
    assert len(got) == 49 and got[0] == "v002"
    assert ingest.missing_transcripts(snippets, done).count() == 40
    assert ingest.missing_transcripts(snippets, done, 0).count() == 0


def test_transcripts(spark, rows):
    segments = spark.createDataFrame([("a", 2, "two\nlines"), ("a", 1, "one"), ("b", 1, "x")], "video_id string, pos int, text string")
    assert rows(ingest.joined_segments(segments, ["video_id"], "pos", "text")) == [("a", "one two lines"), ("b", "x")]
    attempts = spark.createDataFrame([("a", "FAILED_FETCH"), ("b", None), ("c", "t")], "video_id string, transcript string")
    assert rows(ingest.fetched_transcripts(attempts), "video_id") == [("b",), ("c",)]
    assert tuple(ingest.unavailable_count(attempts).first()) == (2, 1)


def test_jsonl_projection_and_merge(spark, rows):
    old, new = fresh_path(spark, "old"), fresh_path(spark, "new")
    lines = ['{"scraped_at": "2024-01-09T00:00:00", "keep": 1}', '{"scraped_at": "2024-01-01T00:00:00"}', "{broken", '{"other": 1}']
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(old)
    fresh = spark.createDataFrame([("x", None)], "video_id string, video_format string")
    as_of = F.lit("2024-01-10T00:00:00Z")
    files.merge_jsonl(spark, old, fresh, new, True, 3, as_of)
    got = sorted(r[0] for r in spark.read.text(new).collect())
    assert got == sorted([lines[0], '{"video_id":"x","video_format":null}'])
    verbatim = files.merged_jsonl(spark.read.text(old), fresh, False)
    assert verbatim.count() == 5
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_jsonl(spark, old, REGISTRY).collect()
    only = files.read_jsonl(spark, new, REGISTRY, "video_id").where("video_id IS NOT NULL")
    assert rows(only) == [("x",)]


def test_microseconds_survive_json(spark):
    path = fresh_path(spark, "json")
    df = spark.createDataFrame([("2024-01-01 00:00:00.123456",)], "s string").select(F.col("s").cast("timestamp").alias("scraped_at"))
    files.write_jsonl(df, path)
    assert files.read_jsonl(spark, path, RAW_VIDEOS, "scraped_at").first()[0].microsecond == 123456


def test_landing_keeps_the_registry_and_prunes_payloads(spark):
    as_of = F.lit("2024-01-10T00:00:00Z")
    batches = {
        "raw_videos": videos(spark, ("2024-01-01", {}), ("2024-01-09", {})),
        "registry": registry(spark, a="Short").withColumn("first_scraped_at", F.lit("2020-01-01").cast("timestamp")),
    }
    root = land_run(spark, batches, "table", fresh_path(spark, "raw"), as_of)
    assert tables.read_table(spark, f"{root}/raw_videos", RAW_VIDEOS).count() == 1
    assert tables.read_table(spark, f"{root}/registry", REGISTRY).count() == 1
    assert tables.read_table(spark, f"{root}/raw_comments", RAW_COMMENTS).count() == 0
    first = land_run(spark, batches, "jsonl", None, as_of)
    second = land_run(spark, batches, "jsonl", first, as_of)
    assert spark.read.text(f"{second}/raw_videos").count() == 3
    assert spark.read.text(f"{second}/registry").count() == 2
    with pytest.raises(ValueError):
        land_run(spark, batches, "tape", first, as_of)


def test_upsert_plan_carries_no_text_through_an_aggregate(spark):
    one = spark.createDataFrame([], SNIPPETS)
    plan = ingest.upserted(one, one.withColumn("position", F.lit(1)), "video_id", ingest.SNIPPET_OVERWRITE)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_upsert_keeps_null_keys_and_ties(spark, rows):
    data = [(None, "f1", "l1", 5), ("a", "f2", "l2", 7), ("a", "f2", "l2", 7), ("a", "f3", "l3", 7), (None, "f4", "l4", 6), ("b", "f5", "l5", None)]
    df = spark.createDataFrame(data, "k string, f string, l string, at long")
    got = ingest.upserted(None, df, "k", ["l"], ["at"])
    assert rows(got) == sorted([(None, "f1", "l4"), ("a", "f2", "l3"), ("b", "f5", "l5")], key=repr)


def test_integrity(spark, rows):
    parent = registry(spark, a="Short", b="Unknown")
    child = spark.createDataFrame([("a", 1), ("c", 2), ("c", 2), (None, 3)], "video_id string, n int")
    assert rows(integrity.duplicate_keys(child, ["video_id", "n"], "copies")) == [("c", 2, 2)]
    assert integrity.orphans(child, parent, ["video_id"]).count() == 3
    assert rows(integrity.cascade_delete(child, parent, ["video_id"])) == [("a", 1)]
    assert tuple(integrity.null_violations(child, ["video_id", "n"]).first()) == (1, 0)
    good, bad = integrity.quarantine(parent, "video_format", ["Short"])
    assert rows(good, "video_id") == [("a",)] and rows(bad, "video_id") == [("b",)]
    with pytest.raises(Exception, match="outside its domain"):
        integrity.enforce_domain(parent, "video_format", ["Short"]).collect()
    with pytest.raises(Exception, match="unsigned"):
        spark.range(1).select(integrity.unsigned(F.lit(-1), 65535)).collect()


def test_missing_counts_nan_and_infinity(spark, rows):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (float("inf"), "b"), (None, "c")], "x double, s string")
    assert rows(integrity.missing_and_infinite(df)) == [("s", 1, 0), ("x", 2, 1)]
    assert rows(integrity.profile(df), "column_name", "dtype", "non_null", "n_rows", "n_columns") == [
        ("s", "string", 3, 4, 2), ("x", "double", 3, 4, 2),
    ]


def test_json_validity(spark):
    good = ['{"a":1}', ' {"a":1,"a":2} ', "[]", "3", '{"a":{"b":[1,"]"]}}']
    bad = ["", "{", '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}],[{"b":2}', '{"a":1},"end":1,"b":{}', '{"a":1}},{"b":2', "{a", None]
    df = spark.createDataFrame([(v,) for v in good + bad], "value string")
    got = [r[0] for r in df.select(files.is_json(F.col("value"))).collect()]
    assert got == [True] * len(good) + [False] * len(bad)
