"""Substring dedup: repeated runs of words are removed from all but the first document.

Every window of thirteen words has a Rabin-Karp hash, a polynomial in the 64-bit
hashes of its words. Windows that also start in a document with a smaller id
are marked, and marked windows that overlap or adjoin merge into intervals.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from cardweave.llm.windows import Group, Units, mark_repeats

#: Consecutive words that count as a repeat.
WINDOW = 13


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _finish(table: pa.Table, group: Group, gone: np.ndarray) -> pa.Table:
    out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": [], "removed": []}
    begin = 0
    for row, end in zip(group.rows.tolist(), group.ends.tolist()):
        mask, words = gone[begin:end], group.units[begin:end]
        edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
        if len(edges):
            words = [w for w, g in zip(words, mask.tolist()) if not g]
        out["doc_id"].append(table.column("id")[row].as_py())
        out["n_words"].append(end - begin)
        out["n_removed"].append(int(mask.sum()))
        out["kept"].append(b" ".join(words).decode("utf-8", "surrogatepass"))
        out["removed"].append([{"start": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()])
        begin = end
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_words": pa.array(out["n_words"], pa.int64()),
                     "n_removed": pa.array(out["n_removed"], pa.int64()), "kept": pa.array(out["kept"], pa.string()),
                     "removed": pa.array(out["removed"], spans)})


def dedup_substrings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                     window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` as (doc_id, n_words, n_removed, kept, removed).

    ``kept`` is the text left, its words joined by one blank; ``removed`` lists
    the maximal intervals of removed words. Windows are judged on the input.

    Null and empty texts and texts of fewer words than a window lose nothing.
    Rows with one id do not make each other's windows repeats; a null id is
    larger than all others. Other columns are ignored.
    """
    return mark_repeats(docs, Units(words_of, _hashes, window, within=False), _finish,
                        "doc_id long, n_words long, n_removed long, kept string, "
                        "removed array<struct<start:long,stop:long>>",
                        doc_id=doc_id, text=text, carried=[], unit_bytes=6)
