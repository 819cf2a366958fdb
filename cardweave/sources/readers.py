"""Readers of topics and tables, batch or streaming."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.schemas import CARD_TRANSACTION, EVENT


def read_messages(spark: SparkSession, path: str, topic: str, streaming: bool = False,
                  fmt: str = "json") -> DataFrame:
    """Records of one topic kept as files: key, value, topic, headers."""
    source = spark.readStream if streaming else spark.read
    return source.format(fmt).schema(EVENT).load(path).select(
        "key", "value", F.lit(topic).alias("topic"), "headers")


def read_topics(spark: SparkSession, paths: dict[str, str], streaming: bool = False,
                fmt: str = "json") -> DataFrame:
    """One stream out of several topics; each record keeps the topic it came from."""
    parts = [read_messages(spark, path, topic, streaming, fmt) for topic, path in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str],
               streaming: bool = False, **options: str) -> DataFrame:
    """The same record shape from Kafka; needs Spark's Kafka connector on the class path."""
    source = spark.readStream if streaming else spark.read
    reader = source.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "subscribe", ",".join(topics)).option("includeHeaders", "true")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "headers")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Stored history rows; a table that was never written is empty."""
    return read_table(spark, path, CARD_TRANSACTION)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table written by the savers, with the batch it came from."""
    full = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
