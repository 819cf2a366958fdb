"""Structured Streaming driver: every micro-batch runs the batch flow.

State lives in the stored tables, which a micro-batch reads by its own keys and only as
the batches before left them. It owns one folder per table, so a batch that is run
again after a failure reads the same state and replaces its own output, and all of
its tables become visible at once when its snapshot is written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardweave.operators.matching import MATCH_KEYS
from cardweave.plans.flow import Outcome, Stored, run_batch
from cardweave.schemas import (
    JOB_MESSAGE_TYPE, SPENDING_TOTALS, STORED_HISTORY, STORED_INDEX, TRANSACTION_INFO, TYPE_RANK)
from cardweave.session import materialize
from cardweave.sources import envelope, sinks
from cardweave.sources.runs import KeyedTable, Snapshot, Store
from cardweave.sources.topic_log import publish_log
from cardweave.sources.topics import EVENT_NAME, RESULT_TOPIC, error_topic, request_topic, response_topic

# sends topic records: name of the output, rows, batch number
Publish = Callable[[str, DataFrame, int], None]

RESPONSE = [
    "transaction_id", "provider_message_id", "provider_transaction_id", "debit_card_id",
    "spend_group", "message_type", "transaction_timestamp", "client_amount", "client_currency",
    "wirecard_amount", "wirecard_currency", "earmark_amount", "earmark_currency",
    "total_client_amount", "total_client_currency", "total_wirecard_amount",
    "total_wirecard_currency", "total_earmark_amount", "total_earmark_currency",
    "internal_account_id", "internal_account_currency", "request", "ehi_response"]


@dataclass(frozen=True)
class Job:
    """Folders of the stored tables and the reference tables the flow joins."""

    root: str
    settings: DataFrame
    balances: DataFrame
    linked_accounts: DataFrame
    nodes: DataFrame
    processed_at: Column | None = field(default=None)
    buckets: int = 64       # of a stored table, and runs of a level before they are merged
    fanout: int = 8

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def to_requests(decoded: DataFrame) -> DataFrame:
    """Decoded request events as input of the flow; the topic names the job."""
    def by_topic(values: dict[str, object]) -> Column:
        out = F.lit(None)
        for job, value in values.items():
            out = F.when(F.col("topic") == request_topic(job), F.lit(value)).otherwise(out)
        return out

    jobs = {job: job for job in JOB_MESSAGE_TYPE}
    return envelope.to_transaction_info(decoded).withColumns({
        "job": by_topic(jobs), "type_rank": by_topic(TYPE_RANK),
        "message_type": by_topic(JOB_MESSAGE_TYPE),
        "txn_stat_code": F.col("message.txn_stat_code"),
    }).drop("topic", "transaction_id")


def newest_totals(rows: DataFrame) -> DataFrame:
    """One row per card and group, that of the last batch."""
    others = [f.name for f in SPENDING_TOTALS if f.name not in ("debit_card_id", "total_type")]
    newest = F.max_by(F.struct(*others, "batch_id"), "batch_id")
    return rows.groupBy("debit_card_id", "total_type").agg(newest.alias("t")).select(
        "debit_card_id", "total_type", *[f"t.{c}" for c in others], "t.batch_id")


def store_of(spark: SparkSession, job: Job) -> Store:
    """History by transaction, index by match key and totals by card, below the job's folder."""
    shape = {"buckets": job.buckets, "fanout": job.fanout}
    return Store(spark, job.root, [
        KeyedTable("history", STORED_HISTORY, ("transaction_id",), **shape),
        KeyedTable("index", STORED_INDEX, tuple(MATCH_KEYS), **shape),
        KeyedTable("totals", SPENDING_TOTALS, ("debit_card_id",), newest=newest_totals, **shape)])


def stored_before(store: Store, snapshot: Snapshot, job: Job) -> Stored:
    """Tables as the batches of a snapshot left them; they are read by key."""
    return Stored(
        history=store.asked(snapshot, "history"), index=store.asked(snapshot, "index"),
        totals=store.asked(snapshot, "totals"), settings=job.settings, balances=job.balances,
        linked_accounts=job.linked_accounts, nodes=job.nodes)


def published(spark: SparkSession, job: Job, name: str) -> DataFrame:
    """Topic records in the job's folder of all batches that are whole."""
    batch = store_of(spark, job).snapshot().batch
    return spark.read.schema("key string, value string, headers array<struct<key:string,value:binary>>, "
                             "batch_id long, topic string").json(job.path(name)).where(F.col("batch_id") <= batch)


def process_batch(records: DataFrame, batch_id: int, job: Job,
                  publish: Publish | None = None) -> Outcome | None:
    """Decode, process and store one micro-batch of request events.

    ``publish(name, records, batch_id)`` sends the events, commands and errors as
    topic records; without it they go to folders of the job. The snapshot comes
    last: a batch that breaks off leaves nothing that counts and is done again
    from the same state. A batch that is whole already is left alone (None).
    """
    publish = publish or (lambda name, rows, n: sinks.publish(rows, job.path(name), n))
    spark = records.sparkSession
    store = store_of(spark, job)
    snapshot = store.snapshot()
    if batch_id <= snapshot.batch:
        return None
    decoded, broken = envelope.split_errors(envelope.decode(materialize(records), TRANSACTION_INFO))
    outcome = run_batch(to_requests(decoded), stored_before(store, snapshot, job), job.processed_at)

    def columns(rows: DataFrame, schema) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema])

    whole = store.add(snapshot, batch_id, {
        "history": columns(outcome.history, STORED_HISTORY),
        "index": columns(outcome.index.where(F.col("error").isNull()), STORED_INDEX),
        "totals": columns(outcome.totals, SPENDING_TOTALS)})
    publish("events", _events(outcome), batch_id)
    commands = outcome.accounting.commands.unionByName(outcome.earmarking.commands)
    publish("commands", envelope.to_commands(commands), batch_id)
    failed = outcome.errors.select("key", "process_id", "error", "job").unionByName(
        outcome.accounting.errors.select("key", "process_id", "error", "job")).unionByName(
        outcome.earmarking.errors.select("key", "process_id", "error", "job"))
    topic = F.concat(F.lit("cards."), F.replace("job", F.lit("_"), F.lit(".")), F.lit(".error"))
    errors = envelope.format_error(failed, "job", keep=[topic.alias("topic")]).unionByName(
        envelope.format_error(broken, keep=[F.replace(
            "topic", F.lit(".request"), F.lit(".error")).alias("topic")]))
    publish("errors", errors.withColumnRenamed("message", "value"), batch_id)
    store.commit(whole)
    merged = store.compact(whole)
    if merged != whole:
        store.commit(merged)
    return outcome


def _events(outcome: Outcome) -> DataFrame:
    """Responses of the request jobs and the result events of the downstream jobs."""
    responses = envelope.to_events(outcome.processed, EVENT_NAME["request"], "", RESPONSE, keep=[
        F.concat(F.lit("cards."), F.replace("job", F.lit("_"), F.lit(".")), F.lit(".response"))
        .alias("topic")])
    saved = envelope.to_events(
        outcome.processed, EVENT_NAME["save_history"], RESULT_TOPIC["save_history"], RESPONSE)
    spent = envelope.to_events(
        outcome.spend_events, EVENT_NAME["total_spend"], RESULT_TOPIC["total_spend"],
        ["debit_card_id", "spend_group", "daily_total", "annual_total"])
    done = [envelope.to_events(split.completed, EVENT_NAME[name], RESULT_TOPIC[name], RESPONSE)
            for name, split in (("accounting", outcome.accounting), ("earmarking", outcome.earmarking))]
    out = responses.unionByName(saved).unionByName(spent)
    for part in done:
        out = out.unionByName(part)
    return out


def to_log(path: str) -> Publish:
    """Publish events, commands and errors to a log of topics; a batch done again adds nothing twice."""
    return lambda name, rows, batch_id: publish_log(rows, path, name, batch_id)


def run_stream(records: DataFrame, job: Job, checkpoint: str,
               publish: Publish | None = None) -> StreamingQuery:
    """Process all records that a stream has (key, value, topic, headers), then stop.

    The stream may come from any reader of topics, ``publish`` may send to any sink.
    """
    return (
        records.writeStream.foreachBatch(lambda df, batch_id: process_batch(df, batch_id, job, publish) and None)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def topics_of_requests() -> dict[str, tuple[str, str, str]]:
    """Request, response and error topic per job."""
    return {j: (request_topic(j), response_topic(j), error_topic(j)) for j in JOB_MESSAGE_TYPE}
