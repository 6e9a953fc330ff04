import json

import pytest
from pyspark.sql import functions as F

from tidewright.schemas import STATS
from tidewright.session import fresh_path
from tidewright.streaming import ingest as streams


def land(spark, folder, name, *batches):
    lines = [(json.dumps({"scraped_at": stamp, "video_response": json.dumps(payload)}),) for stamp, payload in batches]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(folder)


def video(vid, title, views):
    return {"id": vid, "snippet": {"title": title, "publishedAt": "2024-01-01T00:00:00Z"}, "statistics": {"viewCount": str(views)}}


@pytest.fixture
def registry(spark):
    return spark.createDataFrame([("a", "Short")], "video_id string, video_format string")


def test_stats_stream_resumes_and_drops_repeats(spark, rows):
    folder, out, marks = (fresh_path(spark, n) for n in ("in", "out", "marks"))
    land(spark, folder, "1", ("2024-01-02T00:00:00Z", {"items": [video("a", "x", 1), video("b", "x", 2)]}))
    streams.stream_stats(spark, folder, out, marks).awaitTermination()
    streams.stream_stats(spark, folder, out, marks).awaitTermination()
    assert streams.read_landed(spark, out, STATS).count() == 2
    land(spark, folder, "2", ("2024-01-02T00:00:00Z", {"items": [video("a", "x", 9)]}), ("2024-01-01T00:00:00Z", {"items": [video("late", "x", 3)]}))
    streams.stream_stats(spark, folder, out, marks).awaitTermination()
    assert rows(streams.read_landed(spark, out, STATS), "video_id", "view_count") == [("a", 1), ("b", 2), ("late", 3)]


def test_older_files_and_null_keys_are_kept(spark, rows):
    folder, out, marks = (fresh_path(spark, n) for n in ("in", "out", "marks"))
    land(spark, folder, "1", ("2024-02-20T00:00:00Z", {"items": [video("a", "x", 1), video(None, "x", 5)]}))
    streams.stream_stats(spark, folder, out, marks).awaitTermination()
    land(spark, folder, "2", ("2024-02-01T00:00:00Z", {"items": [video("a", "x", 2)]}), ("2024-02-20T00:00:00Z", {"items": [video(None, "x", 6)]}))
    streams.stream_stats(spark, folder, out, marks).awaitTermination()
    assert sorted(r["view_count"] for r in streams.read_landed(spark, out, STATS).collect()) == [1, 2, 5]


def test_a_backlog_in_many_batches_loses_nothing(spark):
    folder, out, marks = (fresh_path(spark, n) for n in ("in", "out", "marks"))
    for day in ("28", "01", "15", "28"):
        land(spark, folder, day, (f"2024-02-{day}T00:00:00Z", {"items": [video("a", "x", int(day))]}))
    streams.stream_stats(spark, folder, out, marks, files_per_batch=1).awaitTermination()
    assert sorted(r["view_count"] for r in streams.read_landed(spark, out, STATS).collect()) == [1, 15, 28]


def test_a_replayed_batch_replaces_its_own_output(spark):
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    land(spark, folder, "1", ("2024-02-20T00:00:00Z", {"items": [video("a", "x", 1), video("b", "x", 2)]}))
    for _ in range(2):
        # A lost checkpoint runs the same batch number again.
        streams.stream_stats(spark, folder, out, fresh_path(spark, "marks")).awaitTermination()
    assert streams.read_landed(spark, out, STATS).count() == 2


def test_strict_mark_loses_late_rows(spark, rows):
    folder, out, marks = (fresh_path(spark, n) for n in ("in", "out", "marks"))
    land(spark, folder, "1", ("2024-01-03T00:00:00Z", {"items": [video("a", "x", 1)]}), ("2024-01-02T00:00:00Z", {"items": [video("b", "x", 2)]}))
    streams.stream_stats(spark, folder, out, marks, strict_after=F.lit("2024-01-02").cast("timestamp")).awaitTermination()
    assert rows(streams.read_landed(spark, out, STATS), "video_id") == [("a",)]


def test_upsert_stream_equals_one_run(spark, registry, rows):
    first = ("2024-01-02T00:00:00Z", {"items": [video("a", "old", 1)]})
    second = ("2024-01-03T00:00:00Z", {"items": [video("a", "new", 1), video("b", "only", 1)]})
    stepwise, at_once = fresh_path(spark, "steps"), fresh_path(spark, "once")
    folder, marks = fresh_path(spark, "in"), fresh_path(spark, "marks")
    for batch in (first, second):
        land(spark, folder, "x", batch)
        streams.stream_snippets(spark, folder, registry, stepwise, marks).awaitTermination()
    other = fresh_path(spark, "in")
    land(spark, other, "x", first, second)
    streams.stream_snippets(spark, other, registry, at_once, fresh_path(spark, "marks")).awaitTermination()
    one, two = (streams.read_upserted(spark, p) for p in (stepwise, at_once))
    assert rows(one) == rows(two)
    assert rows(one, "video_id", "video_format", "title") == [("a", "Short", "new"), ("b", "Unknown", "only")]


def test_an_upsert_replays_and_leaves_earlier_batches_alone(spark, registry, rows):
    folder, path = fresh_path(spark, "in"), fresh_path(spark, "table")
    batches = [("2024-01-02T00:00:00Z", {"items": [video("a", "old", 1), video("c", "stays", 1)]}), ("2024-01-03T00:00:00Z", {"items": [video("a", "new", 1)]})]
    for i, batch in enumerate(batches):
        land(spark, f"{folder}/{i}", "x", batch)
    want = [("a", "new"), ("c", "stays")]
    for _ in range(2):
        # A lost checkpoint runs both batch numbers again.
        marks = fresh_path(spark, "marks")
        for i in range(2):
            streams.stream_snippets(spark, f"{folder}/[0-{i}]", registry, path, marks).awaitTermination()
        assert rows(streams.read_upserted(spark, path), "video_id", "title") == want
    stored = spark.read.parquet(path)
    assert rows(stored.select("batch_id", "video_id")) == [(0, "a"), (0, "c"), (1, "a")]


def test_stages_run_in_order():
    log = []

    class Fake:
        def __init__(self, name):
            self.name = name
            log.append(f"start {name}")

        def awaitTermination(self, timeout):
            log.append(f"end {self.name}")
            return self.name != "stuck"

        def stop(self):
            log.append(f"stop {self.name}")

    streams.run_stages([[lambda: Fake("a")], [lambda: Fake("b"), lambda: Fake("c")]])
    assert log == ["start a", "end a", "start b", "start c", "end b", "end c"]
    with pytest.raises(TimeoutError):
        streams.run_stages([[lambda: Fake("stuck")]], timeout=1)
