"""The registered queries: each runs one operator over whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.operators import lookups, matching, processors, spend
from cardweave.operators.authorisation import authorise, enrich_auth
from cardweave.operators.commands import Split
from cardweave.operators.commands import accounting_commands as make_accounting
from cardweave.operators.commands import earmark_commands as make_earmarks
from cardweave.operators.ordered import Running, running
from cardweave.operators.replay import replay
from cardweave.plans.flow import Outcome, Stored, run_batch
from cardweave.schemas import LEDGERS, MONEY, STORED_HISTORY, STORED_INDEX
from cardweave.session import written
from cardweave.sources import derived, envelope
from cardweave.sources.derived import AS_OF, MESSAGE_ORDER, RECORDED
from cardweave.sources.topics import RESULT_TOPIC

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AMOUNTS = [f"{p}{ledger}_{part}" for p in ("", "total_") for ledger in LEDGERS
           for part in ("amount", "currency")]
RESULT_COLUMNS = ["process_id", "transaction_id", "message_type", "error", "outcome", *AMOUNTS,
                  "internal_account_id", "internal_account_currency"]
CHECKS = ("status", "transaction_type", "merchant", "velocity", "balance")
MATCHED_JOBS = ("authorisation_reversal", "externally_authorised", "financial_reversal",
                "chargeback", "second_presentment", "chargeback_non_credit")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks ---------------------------------------------------------------

_PAYLOAD = T.StructType([
    T.StructField("debit_card_id", T.StringType()), T.StructField("settlement_amount", MONEY),
    T.StructField("provider_message_id", T.StringType())])


def _decoded(spark: SparkSession, folder: str) -> DataFrame:
    return envelope.decode(derived.event_envelopes(spark, folder), _PAYLOAD)


@query
def decode_envelope(spark: SparkSession, folder: str) -> DataFrame:
    return _decoded(spark, folder).select(
        "key", "topic", F.col("event.process_id").alias("process_id"),
        F.col("event.event_name").alias("event_name"), "event.payload.*", "error")


@query
def error_sink(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = envelope.split_errors(_decoded(spark, folder))
    return envelope.format_error(bad)


# --- matching ------------------------------------------------------------------------


@query
def matching_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived.messages(spark, folder).withColumnsRenamed({
        "message": "request", "transaction_date_time": "timestamp"})
    tags = F.array_join(F.transform(
        F.map_entries("tags"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return matching.matching_index(rows, ["timestamp", "process_id"]).select(
        "process_id", "transaction_id", "card_token", "tag_set", "signature",
        tags.alias("tags"), "error")


@query
def match_required(spark: SparkSession, folder: str) -> DataFrame:
    requests = derived.messages(spark, folder).where(
        F.col("job").isin(*MATCHED_JOBS)).drop("transaction_id")
    index = derived.stored_index(spark, folder)
    return matching.match(requests, index, required=True, recorded=RECORDED).select(
        "process_id", "transaction_id", "error")


@query
def match_optional(spark: SparkSession, folder: str) -> DataFrame:
    requests = derived.messages(spark, folder).where("job = 'presentment'").drop("transaction_id")
    index = derived.stored_index(spark, folder)
    return matching.match(requests, index, required=False, recorded=RECORDED).select(
        "process_id", "matched_id", "transaction_id")


# --- lookups -------------------------------------------------------------------------


@query
def history_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.history_lookup(
        derived.messages(spark, folder), derived.with_slim_message(derived.stored_history(spark, folder)),
        [f"-{c}" for c in RECORDED],
    ).select("transaction_id", "position", "process_id", "message_type", "earmark_amount",
             "client_amount", "wirecard_amount")


@query
def latest_transaction(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["process_id", "message_type", "earmark_amount", "client_amount", "wirecard_amount"]
    found = lookups.latest_transaction(
        derived.messages(spark, folder), derived.stored_history(spark, folder), columns, RECORDED)
    return found.select("process_id", "transaction_id",
                        *[F.col(f"latest.{c}").alias(f"latest_{c}") for c in columns])


@query
def first_authorisation(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["process_id", "earmark_amount"]
    return lookups.first_authorisation(
        derived.stored_history(spark, folder), columns, RECORDED,
    ).select("transaction_id", *[F.col(f"authorisation.{c}").alias(c) for c in columns])


@query
def linked_account_asof(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.linked_account_asof(
        derived.messages(spark, folder).drop("message"), derived.linked_accounts(spark, folder),
    ).select("process_id", "debit_card_id", "transaction_date_time", "linked_account_id",
             "linked_account_currency", "from_timestamp")


@query
def duplicate_check(spark: SparkSession, folder: str) -> DataFrame:
    """Every message against the history of all messages stored up to a day.

    The history stands for what was stored when the later messages came; were it whole,
    every message would find itself there and none would be new.
    """
    return lookups.flag_duplicates(
        derived.messages(spark, folder), derived.stored_history(spark, folder, until=derived.CUT),
    ).select("process_id", "transaction_id", "provider_message_id", "is_duplicate")


@query
def order_validation(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.check_order(
        derived.line_messages(spark, folder), derived.stored_history(spark, folder),
    ).select("process_id", "transaction_id", "message_type", "order_ok")


@query
def node_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.with_node(
        derived.processed_messages(spark, folder), derived.processor_nodes(spark, folder),
    ).select("process_id", "internal_account_id", "node_id", "gps_account_id", "topic")


@query
def auth_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    enriched = enrich_auth(
        derived.authorisation_requests(spark, folder), derived.card_settings(spark, folder),
        derived.account_balances(spark, folder), derived.spend_snapshot(spark, folder),
        derived.stored_index(spark, folder), RECORDED)
    return enriched.select(
        "process_id", "matched_id", "transaction_id", "gated", "reads_balance",
        F.col("settings.card_status").alias("card_status"),
        F.col("balance.available").alias("available"),
        F.col("totals.daily_total").alias("daily_total"),
        F.col("totals.annual_total").alias("annual_total"))


def _spend_history(spark: SparkSession, folder: str) -> DataFrame:
    return derived.spend_messages(spark, folder).withColumnsRenamed({
        "processed_at": "timestamp", "process_id": "provider_message_id"})


@query
def spend_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    totals = derived.event_spend_snapshot(spark, folder).withColumnsRenamed({
        "total_type": "spend_group", "timestamp": "stored_at"})
    return spend.enrich_spend(
        derived.spend_messages(spark, folder), _spend_history(spark, folder),
        ["timestamp", "event_id"],
    ).join(totals, spend.CARD_KEYS, "left").select(
        "event_id", "message_type", "daily_total", "annual_total", "stored_at",
        F.col("authorisation.provider_message_id").alias("authorisation_id"),
        F.col("authorisation.earmark_amount").alias("authorisation_earmark"))


# --- running state -------------------------------------------------------------------


@query
def running_ledger_totals(spark: SparkSession, folder: str) -> DataFrame:
    moves = F.col("job").isin("presentment", "financial_reversal", "chargeback",
                              "second_presentment")
    client = F.when(moves, F.col("settlement_amount")).otherwise(F.lit(0).cast(MONEY))
    totals = running(
        derived.messages(spark, folder).drop("message"), ["transaction_id"], MESSAGE_ORDER,
        {"total_client_amount": Running("sum", client),
         "total_wirecard_amount": Running("sum", -client)})
    return totals.select(
        "process_id", "transaction_id", F.col("total_client_amount").cast(MONEY)
        .alias("total_client_amount"),
        F.col("total_wirecard_amount").cast(MONEY).alias("total_wirecard_amount"))


@query
def lifecycle_replay(spark: SparkSession, folder: str) -> DataFrame:
    return replay(derived.messages(spark, folder).drop("message"), MESSAGE_ORDER).select(
        *RESULT_COLUMNS)


SPEND_ORDER = ["processed_at", "event_id"]


@query
def spend_totals(spark: SparkSession, folder: str) -> DataFrame:
    authorised = F.when(F.col("message_type") == "AUTHORISATION", F.struct("earmark_amount"))
    rows = running(
        derived.spend_messages(spark, folder), ["transaction_id"], SPEND_ORDER,
        {"earlier": Running("last", authorised)}, exclusive=True)
    enriched = rows.withColumn(
        "authorisation", F.when(F.col("message_type") == "PRESENTMENT", F.col("earlier"))
    ).drop("earlier")
    return spend.spend_totals(
        enriched, SPEND_ORDER, derived.event_spend_snapshot(spark, folder),
    ).select("event_id", "debit_card_id", "spend_group", "action", "daily_total", "annual_total",
             "processed_at")


@query
def total_spend_update(spark: SparkSession, folder: str) -> DataFrame:
    return spend.total_spend_update(
        derived.spend_messages(spark, folder), derived.event_spend_snapshot(spark, folder),
        _spend_history(spark, folder), ["timestamp", "event_id"],
    ).select("event_id", "debit_card_id", "spend_group", "action", "error", "daily_total",
             "annual_total")


# --- request jobs --------------------------------------------------------------------


def _job(name: str, requests: DataFrame, folder: str) -> DataFrame:
    history = derived.stored_history(requests.sparkSession, folder, name)
    return processors.process_requests(name, requests.drop("message"), history, RECORDED).select(
        *RESULT_COLUMNS)


def _lines(spark: SparkSession, folder: str, job: str) -> DataFrame:
    return derived.line_messages(spark, folder).where(F.col("job") == job)


@query
def authorisation(spark: SparkSession, folder: str) -> DataFrame:
    return authorise(
        derived.authorisation_requests(spark, folder), derived.card_settings(spark, folder),
        derived.account_balances(spark, folder), derived.spend_snapshot(spark, folder),
        derived.stored_index(spark, folder),
        derived.stored_history(spark, folder, "authorisation"), RECORDED, [f"{c}_check" for c in CHECKS],
    ).select(
        *RESULT_COLUMNS, "response_status",
        *[F.col(f"{c}_check.valid").alias(f"{c}_valid") for c in CHECKS])


@query
def authorisation_reversal(spark: SparkSession, folder: str) -> DataFrame:
    return _job("authorisation_reversal", _lines(spark, folder, "authorisation_reversal"), folder)


@query
def externally_authorised(spark: SparkSession, folder: str) -> DataFrame:
    return _job(
        "externally_authorised", derived.external_authorisations(spark, folder), folder)


@query
def presentment(spark: SparkSession, folder: str) -> DataFrame:
    """Matched through the index; unmatched or without history settles offline."""
    requests = derived.messages(spark, folder).where("job = 'presentment'").drop(
        "transaction_id", "linked_account_id", "linked_account_currency")
    index = derived.stored_index(spark, folder)
    matched = matching.match(requests, index, required=False, recorded=RECORDED)
    # what neither the account's lookup nor the rule reads stays behind
    needed = [c for c in matched.columns if c in (*processors.RULE_COLUMNS, "debit_card_id", "transaction_date_time")]
    linked = written(lookups.linked_account_asof(
        matched.select(*needed), derived.linked_accounts(spark, folder)).select(*[
            c for c in processors.RULE_COLUMNS if c != "response_status"]))
    return processors.process_requests(
        "presentment", linked, derived.stored_history(spark, folder, "presentment"), RECORDED,
    ).select(*RESULT_COLUMNS)


@query
def financial_reversal(spark: SparkSession, folder: str) -> DataFrame:
    return _job("financial_reversal", _lines(spark, folder, "financial_reversal"), folder)


@query
def chargeback(spark: SparkSession, folder: str) -> DataFrame:
    return _job("chargeback", _lines(spark, folder, "chargeback"), folder)


@query
def second_presentment(spark: SparkSession, folder: str) -> DataFrame:
    return _job("second_presentment", _lines(spark, folder, "second_presentment"), folder)


@query
def chargeback_non_credit(spark: SparkSession, folder: str) -> DataFrame:
    return _job("chargeback_non_credit", _lines(spark, folder, "chargeback_non_credit"), folder)


# --- downstream jobs -----------------------------------------------------------------


def _command_columns(commands: DataFrame, *more: Column) -> DataFrame:
    info, accounts = F.col("command.transaction_info"), F.col("command.accounting_info")
    tags = F.array_join(F.transform("command.accounting_tags", lambda t: F.concat(
        t["key"], F.lit("="), F.coalesce(t["value"], F.lit("")))), ";")
    return commands.select(
        "process_id", "command_name", "command_key", "topic",
        F.col("command.entry_origin").alias("entry_origin"),
        accounts["debit_account"]["account_id"].alias("debit_account"),
        accounts["debit_balance_update"].alias("debit_balance_update"),
        accounts["credit_account"]["account_id"].alias("credit_account"),
        accounts["credit_balance_update"].alias("credit_balance_update"),
        info["amount"].alias("amount"), info["currency"].alias("currency"), info["id"].alias("id"),
        info["direction"].alias("direction"), info["transaction_type"].alias("transaction_type"),
        tags.alias("tags"),
        F.element_at("headers", -1)["key"].alias("header_key"),
        F.decode(F.element_at("headers", -1)["value"], "UTF-8").alias("header_value"), *more)


def _accounting(spark: SparkSession, folder: str):
    return make_accounting(derived.processed_messages(spark, folder),
                           derived.processor_nodes(spark, folder), RESULT_TOPIC["accounting"])


def _earmarks(spark: SparkSession, folder: str):
    return make_earmarks(
        derived.processed_messages(spark, folder), derived.processor_nodes(spark, folder),
        RESULT_TOPIC["earmarking"])


@query
def accounting_commands(spark: SparkSession, folder: str) -> DataFrame:
    return _command_columns(_accounting(spark, folder).commands)


@query
def accounting_completed(spark: SparkSession, folder: str) -> DataFrame:
    return _accounting(spark, folder).completed.select("process_id", "transaction_id", "job")


@query
def accounting_errors(spark: SparkSession, folder: str) -> DataFrame:
    return _accounting(spark, folder).errors.select(
        "process_id", "error", "client_amount", "wirecard_amount")


@query
def earmark_commands(spark: SparkSession, folder: str) -> DataFrame:
    commands = _earmarks(spark, folder).commands
    # the JSON copy of the message is checked through one of its fields
    return _command_columns(commands, F.get_json_object(
        "command.transaction_info.data", "$.provider_message_id").alias("data_message_id"))


@query
def earmarking_completed(spark: SparkSession, folder: str) -> DataFrame:
    return _earmarks(spark, folder).completed.select("process_id", "transaction_id", "job")


# --- everything ----------------------------------------------------------------------


def stored_tables(spark: SparkSession, folder: str) -> Stored:
    """Reference tables of the folder, and no history yet."""
    empty = {"history": spark.createDataFrame([], STORED_HISTORY),
             "index": spark.createDataFrame([], STORED_INDEX)}
    return Stored(
        **empty, totals=derived.spend_snapshot(spark, folder),
        settings=derived.card_settings(spark, folder),
        balances=derived.account_balances(spark, folder),
        linked_accounts=derived.linked_accounts(spark, folder),
        nodes=derived.processor_nodes(spark, folder))


def _flow(spark: SparkSession, folder: str, processed_at: Column | None = None) -> Outcome:
    return run_batch(derived.end_to_end_requests(spark, folder), stored_tables(spark, folder),
                     F.lit(AS_OF).cast("timestamp_ntz") if processed_at is None else processed_at, written)


@query
def end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """All requests of all jobs through matching and replay, errors included."""
    outcome = _flow(spark, folder)
    done = outcome.processed.select(*RESULT_COLUMNS)
    lost = outcome.rejected.select("process_id", "error")
    return done.unionByName(lost, allowMissingColumns=True)


@query
def flow_history(spark: SparkSession, folder: str) -> DataFrame:
    """History rows that the processed messages of the flow leave."""
    amounts = [f"{ledger}_{part}" for ledger in LEDGERS for part in ("amount", "currency")]
    return _flow(spark, folder).history.select(
        "process_id", "transaction_id", "provider_message_id", "provider_transaction_id", "message_type",
        "debit_card_id", "internal_account_id", "internal_account_currency", *amounts)


@query
def flow_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index rows that the processed messages of the flow leave."""
    return _flow(spark, folder).index.select(
        "process_id", "transaction_id", "card_token", "tag_set", "signature", "error")


@query
def flow_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Spend totals of the flow, each message processed at its own time; errors included."""
    outcome = _flow(spark, folder, F.col("transaction_date_time"))
    saved = outcome.spend.select("process_id", "action", "daily_total", "annual_total")
    return saved.unionByName(outcome.spend_errors.select("process_id", "error"), allowMissingColumns=True)


@query
def flow_commands(spark: SparkSession, folder: str) -> DataFrame:
    """Accounting and earmark commands of the flow, rejected ones included."""
    outcome = _flow(spark, folder)

    def rows(name: str, split: Split) -> DataFrame:
        info, accounts = F.col("command.transaction_info"), F.col("command.accounting_info")
        sent = split.commands.select(
            F.lit(name).alias("kind"), "process_id", "topic", info["transaction_type"].alias("direction"),
            info["amount"].alias("amount"), info["currency"].alias("currency"),
            accounts["debit_account"]["account_id"].alias("debit_account"),
            accounts["credit_account"]["account_id"].alias("credit_account"))
        return sent.unionByName(split.errors.select(F.lit(name).alias("kind"), "process_id", "error"),
                                allowMissingColumns=True)

    return rows("accounting", outcome.accounting).unionByName(rows("earmark", outcome.earmarking))
