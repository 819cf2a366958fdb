"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cardweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the clock pinned to UTC.

    The number of shuffle partitions is left to the cluster; adaptive execution
    merges small ones and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def _shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, the one the session names in ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where no other machine could need it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="cardweave-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage at a copy in the cluster's shared checkpoint folder."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same by a Parquet copy, for wide rows: a third of the bytes or less, and readers take only their columns.

    Spark's cleaner does not know such a copy; where it removes checkpoints, the copy goes
    at the end of the session.
    """
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/written-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if spark.conf.get("spark.cleaner.referenceTracking.cleanCheckpoints", "false") == "true":
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
