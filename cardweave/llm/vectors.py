"""Vector rows: which of them take part, and their matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of query vectors and what belongs to them that are broadcast at a time.
PASS_BYTES = 16 << 20


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def one_row_an_id(rows: DataFrame, key: str) -> DataFrame:
    """Of rows with one id, that with the least other columns; rows without an id go.

    Reduced before the shuffle, so an id that very many rows share costs one row a task.
    """
    others = [c for c in rows.columns if c != key]
    return (rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("least"))
            .select(key, *[f"least.{c}" for c in others]))


def matrix(lists: pa.Array, width: int, kind: type) -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), kind)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
