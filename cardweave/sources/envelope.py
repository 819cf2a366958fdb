"""Event strings to typed rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.schemas import HEADERS, TRANSACTION_INFO

CORRUPT = "_undecodable"


def envelope(payload: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("key", T.StringType()), T.StructField("process_id", T.StringType()),
        T.StructField("event_name", T.StringType()), T.StructField("payload", payload),
        T.StructField(CORRUPT, T.StringType())])


def decode(records: DataFrame, payload: T.StructType) -> DataFrame:
    """Add ``event`` and ``error``; a value that is not such an event has only the error."""
    parsed = F.from_json("value", envelope(payload), {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
    bad = (F.col("event").isNull() | F.col(f"event.{CORRUPT}").isNotNull()
           | F.col("event.payload").isNull())
    return records.withColumn("event", parsed).withColumn(
        "error", F.when(bad, F.lit("undecodable_event"))).withColumn(
        "event", F.when(F.col("error").isNull(), F.col("event")))


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without an error, and rows with one."""
    return (rows.where(F.col("error").isNull()).drop("error"),
            rows.where(F.col("error").isNotNull()))


def to_transaction_info(decoded: DataFrame) -> DataFrame:
    """Flatten decoded request events to the columns the request jobs work on, headers kept."""
    ids = {"key", "process_id"}
    headers = F.col("headers") if "headers" in decoded.columns else F.lit(None)
    return decoded.select(
        "topic", headers.cast(HEADERS).alias("headers"), F.col("event.key").alias("key"), F.col("event.process_id").alias("process_id"),
        *[F.col(f"event.payload.{f.name}").alias(f.name) for f in TRANSACTION_INFO
          if f.name not in ids])


def to_events(rows: DataFrame, event_name: str, topic: str, payload: list[str],
              keep: list[Column] | None = None) -> DataFrame:
    """Rows as topic records: key, JSON value, topic (``keep`` gives a topic per row)."""
    value = F.to_json(F.struct(
        "key", "process_id", F.lit(event_name).alias("event_name"),
        F.struct(*payload).alias("payload")))
    return rows.select("key", value.alias("value"), *(keep or [F.lit(topic).alias("topic")]))


def to_commands(commands: DataFrame) -> DataFrame:
    """Commands as topic records; each row names its own topic and headers."""
    value = F.to_json(F.struct(
        "key", "process_id", F.col("command_name").alias("event_name"),
        F.col("command").alias("payload")))
    return commands.select(F.col("command_key").alias("key"), value.alias("value"), "topic", "headers")


def format_error(rows: DataFrame, event_data: str = "value",
                 keep: list[Column] | None = None) -> DataFrame:
    """Error records: the failed event, what went wrong and where, as one text."""
    def text(name: str):
        known = F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")
        return F.coalesce(known, F.lit("null"))

    # Fixed value: layout of the error text, whose last bracket stays open.
    message = F.concat(
        F.lit("[processId: "), text("process_id"), F.lit("][eventData: "), text(event_data),
        F.lit("][exceptionMessage: "), text("error"),
        F.lit("][exceptionStackTrace: "), text("stack_trace"))
    return rows.select("key", message.alias("message"), *(keep or []))
