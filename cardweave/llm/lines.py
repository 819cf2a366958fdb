"""Line dedup: windows of three lines that occurred before are removed.

Consecutive lines are hashed together; of each repeated window the first
occurrence stays, and the lines that later occurrences cover are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from cardweave.llm.windows import Group, Units, mark_repeats

#: Consecutive lines that count as a repeat.
WINDOW = 3


def lines_of(text: str | None) -> list[str]:
    """Lines parted by line feeds; a null text has none."""
    return [] if text is None else text.split("\n")


def _hashes(lines: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines),
                       np.uint64, len(lines))


def _finish(table: pa.Table, group: Group, gone: np.ndarray) -> pa.Table:
    order = pa.array(group.rows)
    texts = table.column("text").take(order).to_pylist()
    n_lines, n_removed, begin = [], [], 0
    for k, end in enumerate(group.ends.tolist()):
        mask = gone[begin:end]
        n_lines.append(end - begin)
        n_removed.append(int(mask.sum()))
        if n_removed[-1]:
            texts[k] = "\n".join(x for x, g in zip(group.units[begin:end], mask.tolist()) if not g)
        begin = end
    return pa.table({"id": table.column("id").take(order), "n_lines": pa.array(n_lines, pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()), "text": pa.array(texts, pa.string()),
                     "rest": table.column("rest").take(order)})


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the repeated lines removed from ``text``; all columns and rows stay.

    A line occurrence is earlier if it is in a document with a smaller id, or
    further up in the same row. ``counts`` names two columns to add: the lines
    of the input and those removed.

    A null text stays null, one with fewer lines than a window stays as it is, and
    one that loses all lines becomes empty. Blank lines are lines like others.
    Rows with one id are no earlier than each other, so repeated rows stay alike;
    a null id is larger than all others. Names of other columns do not matter.
    """
    carried = [c for c in docs.columns if c != text]
    rest = T.StructType([docs.schema[c] for c in carried])
    schema = (T.StructType().add("id", "long").add("n_lines", "long").add("n_removed", "long")
              .add("text", "string").add("rest", rest))
    marked = mark_repeats(docs, Units(lines_of, _hashes, window, within=True), _finish, schema,
                          doc_id=doc_id, text=text, carried=carried, unit_bytes=100)
    columns = [F.col("text").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    if counts:
        columns += [F.col("n_lines").alias(counts[0]), F.col("n_removed").alias(counts[1])]
    return marked.select(*columns)
