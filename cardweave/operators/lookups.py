"""Joins of messages to stored history, accounts and nodes."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.functions.ledger import ORDER_RULES, order_ok, type_bit
from cardweave.operators.ordered import WINDOW_ROWS, Running, asof_join, numbered, running

AUTHORISATION_TYPES = ("AUTHORISATION",)
BROADCAST_NODES = 10_000
TASK_ROWS = 500_000     # some 600 MB sorted


def requested_history(messages: DataFrame, history: DataFrame) -> DataFrame:
    """History rows of the transactions the messages belong to, and no others."""
    return history.join(messages.select("transaction_id"), "transaction_id", "left_semi")


def history_lookup(messages: DataFrame, history: DataFrame, newest_first: Sequence[str],
                   limit: int = WINDOW_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """History of the messages' transactions, numbered from the newest row (position 1).

    Each history row appears once, whatever the number of messages asking for
    it, so a busy transaction costs its own size and not messages times rows.
    A task sorts whole rows; so above the session's number of partitions there is
    one for every ``task_rows`` rows, and what a task holds does not grow with the history.
    """
    parts = ceil(history.count() / task_rows)
    if parts > int(history.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        history = history.repartition(parts, "transaction_id")
        messages = messages.select("transaction_id").repartition(parts, "transaction_id")
    return running(requested_history(messages, history), ["transaction_id"], newest_first,
                   {"position": Running("sum", F.lit(1))}, limit)


def latest_transaction(messages: DataFrame, history: DataFrame, columns: Sequence[str],
                       recorded: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Left join of each message to the newest history row of its transaction."""
    newest = requested_history(messages, history).groupBy("transaction_id").agg(
        F.max_by(F.struct(*columns), F.struct(*recorded)).alias("latest"))
    return messages.join(newest, "transaction_id", "left")


def first_authorisation(history: DataFrame, columns: Sequence[str],
                        recorded: Sequence[str] = ("timestamp",),
                        types: Sequence[str] = AUTHORISATION_TYPES) -> DataFrame:
    """Per transaction, the first authorisation met when reading newest first."""
    return history.where(F.col("message_type").isin(*types)).groupBy("transaction_id").agg(
        F.max_by(F.struct(*columns), F.struct(*recorded)).alias("authorisation"))


def linked_account_asof(messages: DataFrame, accounts: DataFrame,
                        limit: int = WINDOW_ROWS) -> DataFrame:
    """Account linked to the card at the message's own time; null where none was."""
    payload = ["internal_account_id", "internal_account_currency", "from_timestamp"]
    found = asof_join(
        messages.drop("linked_account_id", "linked_account_currency"), accounts, ["debit_card_id"],
        F.col("transaction_date_time"), F.col("from_timestamp"), payload, limit=limit)
    return found.withColumnsRenamed({
        "internal_account_id": "linked_account_id",
        "internal_account_currency": "linked_account_currency"})


def flag_duplicates(messages: DataFrame, history: DataFrame) -> DataFrame:
    """``is_duplicate``: the transaction's history already has this provider message id."""
    keys = ["transaction_id", "provider_message_id"]
    stored = history.select(*keys).distinct().withColumn("__stored", F.lit(True))
    return messages.join(stored, keys, "left").withColumn(
        "is_duplicate", F.coalesce("__stored", F.lit(False))).drop("__stored")


def check_order(messages: DataFrame, history: DataFrame,
                rules: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``order_ok``: the history has a type this message type may follow."""
    seen = requested_history(messages, history).groupBy("transaction_id").agg(
        F.bit_or(F.expr(type_bit("message_type"))).alias("__types"))
    return messages.join(seen, "transaction_id", "left").withColumn(
        "order_ok", F.expr(order_ok("message_type", "coalesce(__types, 0)",
                                    ORDER_RULES if rules is None else rules))).drop("__types")


def with_node(processed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Node of the internal account; rows with a blank account get a node by hash.

    ``nodes`` has a row per account and grows with the cards, so it is joined and
    not broadcast. The distinct nodes are broadcast while they are few; many
    nodes spread a join over many keys. Without any node the columns are null.
    Rows with and without an account are joined apart, so that no join has a
    key that stands for none.
    """
    parts = ["node_id", "gps_account_id", "topic"]
    owners = nodes.where(F.trim("account_id") != "").select(
        F.col("account_id").alias("internal_account_id"), *parts)
    blank = F.coalesce(F.trim("internal_account_id"), F.lit("")) == ""
    owned = processed.where(~blank).join(owners, "internal_account_id", "left")
    slots, count = numbered(nodes.select(*parts).distinct(), ["node_id", "topic", "gps_account_id"], "__slot")
    if count <= BROADCAST_NODES:
        slots = F.broadcast(slots)
    slot = F.conv(F.substring(F.md5("process_id"), 1, 8), 16, 10).cast("bigint") % max(1, count)
    anywhere = processed.where(blank).withColumn("__slot", slot).join(slots, "__slot", "left")
    columns = [*processed.columns, *parts]
    return owned.select(*columns).unionByName(anywhere.select(*columns))
