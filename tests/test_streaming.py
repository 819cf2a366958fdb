"""A stream leaves what its batches leave, and a repeated batch adds nothing."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cardweave.schemas import STORED_HISTORY, TRANSACTION_INFO
from cardweave.sources import derived, envelope
from cardweave.sources.readers import read_table, read_topics
from cardweave.sources.topic_log import publish_log, read_log
from cardweave.sources.topics import request_topic
from cardweave.streaming.jobs import Job, process_batch, run_stream, store_of, to_log

CUT = "1998-06-01 00:00:00"
STATE = ["process_id", "transaction_id", "provider_message_id", "message_type", "client_amount",
         "wirecard_amount", "earmark_amount", "internal_account_id"]


@pytest.fixture(scope="module")
def records(spark, folder):
    """Requests of a few cards as JSON events, one topic per job."""
    rows = derived.end_to_end_requests(spark, folder).where("debit_card_id < 'C-11'")
    rows = rows.withColumn("transaction_amount", F.col("settlement_amount"))
    payload = F.struct(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TRANSACTION_INFO if f.name not in ("key", "process_id")])
    value = F.to_json(F.struct("key", "process_id", F.lit("REQUEST").alias("event_name"),
                               payload.alias("payload")))
    topic = F.lit(None).cast("string")
    for job in ("authorisation", "authorisation_reversal", "externally_authorised", "presentment",
                "financial_reversal", "chargeback", "second_presentment", "chargeback_non_credit"):
        topic = F.when(F.col("job") == job, request_topic(job)).otherwise(topic)
    return rows.select("key", value.alias("value"), topic.alias("topic"),
                       F.col("transaction_date_time").alias("at")).cache()


def make_job(spark, folder, root):
    return Job(
        root=str(root), settings=derived.card_settings(spark, folder),
        balances=derived.account_balances(spark, folder),
        linked_accounts=derived.linked_accounts(spark, folder),
        nodes=derived.processor_nodes(spark, folder),
        processed_at=F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))


def state(spark, job):
    rows = read_table(spark, job.path("history"), STORED_HISTORY).select(*STATE).collect()
    return sorted(tuple(map(str, r)) for r in rows)


def test_decode_keeps_every_request(spark, records):
    decoded = envelope.decode(records.drop("at"), TRANSACTION_INFO)
    assert decoded.where(F.col("error").isNotNull()).isEmpty()
    assert decoded.where("event.payload.transaction_date_time is null").isEmpty()


def test_stream_equals_batches(spark, folder, records, tmp_path):
    parts = [records.where(F.col("at") < CUT), records.where(F.col("at") >= CUT)]
    batches = make_job(spark, folder, tmp_path / "batches")
    for n, part in enumerate(parts):
        process_batch(part.drop("at"), n, batches)
    expected = state(spark, batches)
    assert expected

    # two arrivals of files, each drained by its own run of the same stream
    job = make_job(spark, folder, tmp_path / "stream")
    folders = {t["topic"]: str(tmp_path / "in" / t["topic"])
               for t in records.select("topic").distinct().collect()}
    for part in parts:
        for topic, path in folders.items():
            part.where(F.col("topic") == topic).drop("at").coalesce(1).write.mode("append").json(path)
        query = run_stream(read_topics(spark, folders, streaming=True), job, str(tmp_path / "checkpoint"))
        query.awaitTermination(600)
        assert query.exception() is None
    assert state(spark, job) == expected

    # the last batch again: same rows, nothing added
    process_batch(parts[1].drop("at"), 1, job)
    assert state(spark, job) == expected
    assert read_topics(spark, folders).count() == records.count()


def test_redelivery_in_a_later_batch_moves_nothing(spark, folder, records, tmp_path):
    job = make_job(spark, folder, tmp_path / "again")
    both = records.where(F.col("topic").isin(
        request_topic("authorisation"), request_topic("presentment"))).drop("at")
    process_batch(both, 0, job)
    again = process_batch(both, 1, job)
    stored = read_table(spark, job.path("history"), STORED_HISTORY).where("batch_id = 0").select(
        "transaction_id", "provider_message_id").distinct()
    known = again.processed.join(stored, ["transaction_id", "provider_message_id"], "left_semi")
    assert {r["job"] for r in known.select("job").distinct().collect()} == {"authorisation", "presentment"}
    assert known.where("outcome <> 'duplicate' or client_amount is not null or earmark_amount is not null"
                       ).isEmpty()


def test_batch_cut_does_not_matter(spark, folder, records, tmp_path):
    """One batch and several in time order leave the same rows."""
    states = []
    for cuts in ([], ["1997-01-01", "1998-06-01"]):
        job = make_job(spark, folder, tmp_path / f"cut{len(cuts)}")
        edges = [None, *cuts, None]
        for n, (low, high) in enumerate(zip(edges, edges[1:])):
            part = records
            part = part.where(F.col("at") >= low) if low else part
            part = part.where(F.col("at") < high) if high else part
            process_batch(part.drop("at"), n, job)
        states.append(state(spark, job))
    assert states[0] and states[0] == states[1]


def test_merchant_and_headers_arrive(spark, folder, records, tmp_path):
    """A blocked merchant declines a request, and a command has the request's headers before its own."""
    job = make_job(spark, folder, tmp_path / "headers")
    job = replace(job, settings=job.settings.withColumns({
        "card_status": F.lit("ACTIVE"), "allowed_types": F.array(F.lit("POS"), F.lit("ECOM")),
        "blocked_merchants": F.array(F.lit("5-LOW"))}))
    auths, merchant = records.where(F.col("topic") == request_topic("authorisation")).drop("at"), F.get_json_object(
        "value", "$.payload.merchant")
    mine = auths.where(merchant == "5-LOW").limit(3)
    free = auths.where(merchant != "5-LOW").limit(40)
    sent = mine.unionByName(free).withColumn("headers", F.array(F.struct(
        F.lit("trace").alias("key"), F.encode(F.col("key"), "UTF-8").alias("value"))))
    published = {}
    outcome = process_batch(sent, 0, job, lambda name, rows, n: published.setdefault(name, rows.collect()))
    assert {r["response_status"] for r in outcome.processed.where("merchant = '5-LOW' and spend_group is not null").collect()} == {"57"}
    assert set(published) == {"events", "commands", "errors"}
    commands = outcome.earmarking.commands.select("process_id", "headers").collect()
    assert commands
    for row in commands:
        assert [h["key"] for h in row["headers"]] == ["trace", "reply-to"]
        assert bytes(row["headers"][0]["value"]).decode() == row["process_id"]


def test_undecodable_records_reach_the_error_topic(spark, folder, records, tmp_path):
    job = make_job(spark, folder, tmp_path / "bad")
    bad = spark.createDataFrame([("k", "not json", request_topic("chargeback"))],
                                "key string, value string, topic string")
    process_batch(records.drop("at").limit(20).unionByName(bad), 0, job)
    errors = spark.read.json(job.path("errors")).where("topic = 'cards.chargeback.error'")
    assert errors.where("value like '%not json%undecodable_event%'").count() == 1


def test_stream_from_log_to_log(spark, folder, records, tmp_path):
    """Requests come from a log of topics and answers go to one; a batch lost before its snapshot is sent once."""
    job, log, out = make_job(spark, folder, tmp_path / "state"), str(tmp_path / "log"), str(tmp_path / "out")
    requests = records.where(F.col("topic") == request_topic("authorisation")).drop("at").limit(20)
    publish_log(requests, log, "producer", 0)
    query = run_stream(read_log(spark, log, [request_topic("authorisation")], streaming=True), job,
                       str(tmp_path / "checkpoint"), to_log(out))
    assert query.awaitTermination(300) and query.exception() is None
    answers = read_log(spark, out, ["cards.authorisation.response"])
    assert answers.count() == 20 and store_of(spark, job).snapshot().batch == 0
    before = read_log(spark, out).count()
    # the same batch by a job that has lost its snapshot
    process_batch(read_log(spark, log), 0, replace(job, root=str(tmp_path / "other")), to_log(out))
    assert read_log(spark, out).count() == before > 20
