"""Accounting and earmark commands."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardweave.functions.tags import accounting_tags
from cardweave.operators.lookups import with_node
from cardweave.schemas import HEADERS

# Names of the command protocol.
SYSTEM = "CARDS_GPS"
COMMAND_NAME = "ACCOUNTING_COMMAND_RECEIVED"
REPLY_TO = "reply-to"


@dataclass(frozen=True)
class Split:
    """Commands to send, processed messages that need none, and rejected rows."""

    commands: DataFrame
    completed: DataFrame
    errors: DataFrame


def _moves(amount: str) -> Column:
    return F.coalesce(F.col(amount) != 0, F.lit(False))


def accounting_direction() -> Column:
    """DEBIT or CREDIT of the client; null where the two ledgers do not mirror."""
    client, wirecard = F.col("client_amount"), F.col("wirecard_amount")
    return (F.when((client < 0) & (wirecard > 0), "DEBIT")
            .when((client > 0) & (wirecard < 0), "CREDIT"))


def earmark_direction() -> Column:
    """DEBIT blocks funds, CREDIT releases them."""
    return F.when(F.col("earmark_amount") < 0, "DEBIT").when(F.col("earmark_amount") > 0, "CREDIT")


def command_body(direction: Column, amount: Column, currency: Column, command_id: Column,
                 client_update: str, scheme_update: str, data: Column) -> Column:
    client, scheme = F.col("internal_account_id"), F.col("gps_account_id")
    debit = direction == "DEBIT"

    def pick(when_debit: Column, when_credit: Column) -> Column:
        return F.when(debit, when_debit).otherwise(when_credit)

    return F.struct(
        F.lit(SYSTEM).alias("entry_origin"),
        F.struct(
            F.struct(pick(client, scheme).alias("account_id")).alias("debit_account"),
            pick(F.lit(client_update), F.lit(scheme_update)).alias("debit_balance_update"),
            F.struct(pick(scheme, client).alias("account_id")).alias("credit_account"),
            pick(F.lit(scheme_update), F.lit(client_update)).alias("credit_balance_update"),
        ).alias("accounting_info"),
        F.struct(
            F.abs(amount).alias("amount"), currency.alias("currency"), command_id.alias("id"),
            F.lit(SYSTEM).alias("system"), F.lit("INTERNAL").alias("direction"),
            direction.alias("transaction_type"), data.cast("string").alias("data"),
        ).alias("transaction_info"),
        accounting_tags(F.col("process_id"), F.col("transaction_id"), F.col("message_type"),
                        F.col("request")).alias("accounting_tags"))


def reply_header(headers: Column, topic: str) -> Column:
    """The given headers with the job's own topic appended as the reply address."""
    own = F.array(F.struct(F.lit(REPLY_TO).alias("key"), F.encode(F.lit(topic), "UTF-8").alias("value")))
    return F.concat(F.coalesce(headers, F.array().cast(HEADERS)), own.cast(HEADERS))


def _emit(needed: DataFrame, direction: Column, body: Column, command_id: Column,
          wrong: str, reply_topic: str, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    headers = F.col("headers") if "headers" in needed.columns else F.lit(None).cast(HEADERS)
    placed = with_node(needed, nodes).withColumn("error", F.coalesce(
        F.when(direction.isNull(), F.lit(wrong)),
        F.when(F.col("topic").isNull(), F.lit("no_processor_node"))))
    commands = placed.where(F.col("error").isNull()).select(
        "key", "process_id", F.lit(COMMAND_NAME).alias("command_name"),
        command_id.alias("command_key"), "topic",
        reply_header(headers, reply_topic).alias("headers"), body.alias("command"))
    return commands, placed.where(F.col("error").isNotNull())


def accounting_commands(processed: DataFrame, nodes: DataFrame, reply_topic: str) -> Split:
    """A command per message that moves the client or the scheme ledger."""
    needs = _moves("client_amount") | _moves("wirecard_amount")
    direction = accounting_direction()
    command_id = F.col("process_id")
    body = command_body(direction, F.col("client_amount"), F.col("client_currency"), command_id,
                        "ALL", "ALL", F.lit(None))
    commands, errors = _emit(processed.where(needs), direction, body, command_id,
                             "inconsistent_ledger_signs", reply_topic, nodes)
    return Split(commands, processed.where(~needs), errors)


def earmark_commands(processed: DataFrame, nodes: DataFrame, reply_topic: str) -> Split:
    """A command per message that blocks or releases funds, with the message as JSON.

    The id is a hash of the process id, so a repeated batch repeats its ids.
    """
    needs = _moves("earmark_amount")
    direction = earmark_direction()
    command_id = F.sha2(F.concat("process_id", F.lit("|earmark")), 256)
    data = F.to_json(F.struct(*[c for c in processed.columns if c != "headers"]))
    body = command_body(direction, F.col("earmark_amount"), F.col("earmark_currency"), command_id,
                        "AVAILABLE", "NONE", data)
    commands, errors = _emit(processed.where(needs), direction, body, command_id,
                             "no_earmark_direction", reply_topic, nodes)
    return Split(commands, processed.where(~needs), errors)
