"""A log of topics loses and repeats nothing, and shows nothing that was not committed."""

import pytest
from pyspark.sql import functions as F

from cardweave.sources import topic_log
from cardweave.sources.topic_log import FORMAT, Log, TopicStreamWriter, Written, as_records, publish_log, read_log


def some(spark, low, high):
    return spark.range(low, high).select(
        F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").cast("string").alias("value"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("topic"),
        F.when(F.col("id") % 2 == 0, F.array(F.struct(F.lit("trace").alias("key"), F.encode(
            F.col("id").cast("string"), "UTF-8").alias("value")))).alias("headers"))


def values(rows):
    return sorted(int(r["value"]) for r in rows.select("value").collect())


def test_round_trip_with_headers(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = some(spark, 0, 500)
    publish_log(rows, path, "w", 0)
    publish_log(some(spark, 0, 7), path, "w", 0)        # the batch again
    back = read_log(spark, path)
    assert back.count() == 500 and back.exceptAll(rows).isEmpty()
    assert values(read_log(spark, path, ["a", "c"])) == [n for n in range(500) if n % 3 != 1]
    assert read_log(spark, path, ["none"]).isEmpty()
    publish_log(some(spark, 0, 0), path, "w", 1)
    publish_log(rows.drop("headers").limit(5), path, "other", 0)
    assert read_log(spark, path).count() == 505
    assert read_log(spark, str(tmp_path / "empty")).isEmpty()


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    """Several topics in one stream, drained by three runs over one checkpoint, into another log."""
    source, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for n, (low, high) in enumerate([(0, 90), (90, 91), (91, 400)]):
        publish_log(some(spark, low, high), source, "w", n)
        query = read_log(spark, source, ["a", "b"], streaming=True).writeStream.format(FORMAT).option(
            "path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        assert query.awaitTermination(120) and query.exception() is None
        assert values(read_log(spark, target)) == [v for v in range(high) if v % 3 < 2]
    wanted = read_log(spark, source, ["a", "b"])
    assert read_log(spark, target).exceptAll(wanted).isEmpty()


def test_a_failed_task_leaves_nothing_visible(spark, tmp_path):
    path = str(tmp_path / "log")
    publish_log(some(spark, 0, 30), path, "w", 0)
    broken = some(spark, 30, 90).withColumn("value", F.when(
        F.col("value") == "77", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        publish_log(broken, path, "w", 1)
    assert values(read_log(spark, path)) == list(range(30))
    publish_log(some(spark, 30, 90), path, "w", 1)
    assert values(read_log(spark, path)) == list(range(90))
    with pytest.raises(Exception, match="without a topic"):
        publish_log(some(spark, 0, 3).withColumn("topic", F.lit(None).cast("string")), path, "w", 2)


def test_written_is_not_visible_before_its_commit(spark, tmp_path):
    """Between a task's write and the commit, and after a commit that broke off, readers see the old log."""
    path = str(tmp_path / "log")
    sink = TopicStreamWriter({"path": path})
    message = sink.write(iter(some(spark, 0, 40).toArrow().to_batches()))
    assert sum(n for _, _, n in message.segments) == 40 and len(message.segments) == 3
    assert read_log(spark, path).isEmpty()
    files, folder = Log(path).place("manifests")
    files.create_dir(folder)
    with files.open_output_stream(f"{folder}/000000000001.json.x.part") as draft:
        draft.write(b"{")
    assert read_log(spark, path).isEmpty()
    sink.commit([message, None, Written([])], 0)
    again = sink.write(iter(some(spark, 0, 40).toArrow().to_batches()))
    sink.commit([again], 0)
    assert values(read_log(spark, path)) == list(range(40))
    assert not any((tmp_path / "log" / "segments" / f).exists() for _, f, _ in again.segments)


def test_only_new_manifests_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for n in range(20):
        Log(path).commit([("a", f"f{n}", 5)], "w", n)
    seen = []
    read = Log.manifest
    monkeypatch.setattr(Log, "manifest", lambda self, n: seen.append(n) or read(self, n))
    found = Log(path).between({"a": 90}, {"a": 100})
    assert [(s.file, s.first) for s in found] == [("f18", 90), ("f19", 95)]
    assert min(seen) >= 18 and topic_log.NOTHING["ends"] == {}
    assert as_records(some(spark, 0, 1)).columns == ["key", "value", "topic", "headers"]
