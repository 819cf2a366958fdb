"""Shared helpers: tables written to the cluster's shared folder, and text basics."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Rows that a Python worker turns into results at a time.
SLICE_ROWS = 1_000

#: Applications whose executors have this package already.
_SHIPPED: set[str] = set()



def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent, local mode takes a temporary folder; on a
    cluster the call fails, as no other machine could read such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="cardweave-llm-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Cuts the lineage: a lost executor costs no recomputation of what is stored,
    and a result that several branches read is computed once.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts."""
    return df.selectExpr(f"sum(octet_length(`{text}`))").first()[0] or 0


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once the executors' Python workers can import this package.

    Functions for Arrow batches are sent by reference, and executors need not
    share the driver's folders, so Spark distributes the package's files.
    """
    context: SparkContext = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="cardweave-files-")) / "cardweave_llm.zip"
        with zipfile.ZipFile(archive, "w") as out:
            out.write(package.parent / "__init__.py", "cardweave/__init__.py")
            for path in sorted(package.glob("*.py")):
                out.write(path, f"cardweave/llm/{path.name}")
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return df


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spark's batches in parts, so that a worker holds the results of few texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)
