"""Writers whose repeat leaves the same tables.

Every batch owns one folder per table and replaces it whole, so a batch that
runs again after a failure does not store anything twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def save_batch(df: DataFrame, path: str, batch_id: int,
               partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    writer = df.drop("batch_id").write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/batch_id={batch_id}")


def save_processed(history_rows: DataFrame, index_rows: DataFrame, history_path: str,
                   index_path: str, batch_id: int) -> None:
    """History first, then the index that points at it."""
    save_batch(history_rows, history_path, batch_id)
    save_batch(index_rows, index_path, batch_id)


def save_totals(totals: DataFrame, path: str, batch_id: int) -> None:
    """Changed totals of the batch; readers take the newest row per card and group."""
    save_batch(totals, path, batch_id)


def current_totals(stored: DataFrame, before_batch: int | None = None) -> DataFrame:
    """Newest stored totals per card and group."""
    rows = stored if before_batch is None else stored.where(F.col("batch_id") < before_batch)
    newest = F.max_by(F.struct("daily_total", "annual_total", "timestamp"), "batch_id")
    return rows.groupBy("debit_card_id", "total_type").agg(newest.alias("t")).select(
        "debit_card_id", "total_type", "t.*")


def publish(records: DataFrame, path: str, batch_id: int) -> None:
    """Topic records to files, one folder per topic; Kafka takes the same columns."""
    save_batch(records, path, batch_id, partition_by=["topic"], fmt="json")


def publish_kafka(records: DataFrame, servers: str) -> None:
    """Topic records to Kafka; topic and headers are taken per row."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "includeHeaders", "true").save()
