"""Benchmark decontamination with Wu-Manber search for many strings at once.

The symbols are words. All windows of one length form a search set: a table
gives for every block of two words how far the search may move on, a bucket for
each last block holds the windows that end with it, and a direct comparison of
the words confirms an occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cardweave.llm.store import shipped, slices

#: Consecutive words of an item that count as a leak.
WINDOW = 10
#: UTF-8 bytes of benchmark texts that one pass over the documents searches for.
#: A larger benchmark is searched in several passes.
PASS_BYTES = 16 << 20

# Every byte that is no ASCII letter, digit or part of a longer character
# separates words; A-Z become a-z.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or b >= 0x61 and b <= 0x7A or b >= 0x80
              else 0x20 for b in range(256))

_FOUND = T.ArrayType(T.StructType().add("item", "string").add("start", "integer").add("stop", "integer"))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class WindowSearch:
    """Wu-Manber tables for windows that all have ``length`` words."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], list[str]]):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        #: last word of a block -> first word of the block -> words to move on
        self.shift: dict[bytes, dict[bytes, int]] = {}
        #: last block -> windows that end with it
        self.bucket: dict[tuple[bytes, ...], list[tuple[list[bytes], list[str]]]] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                firsts = self.shift.setdefault(window[end - 1], {})
                first = window[end - self.block]
                firsts[first] = min(firsts.get(first, self.far), length - end)
            self.bucket.setdefault(window[-self.block:], []).append((list(window), items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start and items of every occurrence in ``words``."""
        shift, far, back, length = self.shift, self.far, self.block - 1, self.length
        at, n = length - 1, len(words)
        while at < n:
            firsts = shift.get(words[at])
            step = far if firsts is None else firsts.get(words[at - back], far)
            if step:
                at += step
                continue
            start = at - length + 1
            for window, items in self.bucket.get(tuple(words[at - back:at + 1]), ()):
                if words[start:at + 1] == window:
                    yield start, items
            at += 1


def searches(items: list[tuple[str, str | None]], window: int = WINDOW) -> list[WindowSearch]:
    """One search set for each window length that the items have."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            owners = by_length.setdefault(size, {}).setdefault(tuple(words[start:start + size]), [])
            if not owners or owners[-1] != item:
                owners.append(item)
    return [WindowSearch(size, windows) for size, windows in sorted(by_length.items())]


def hits_of(words: list[bytes], tables: list[WindowSearch]) -> list[tuple[str, int, int]]:
    """(item, first word, end) of all hits, adjoining hits of an item merged."""
    runs: dict[str, list[list[int]]] = {}
    for table in tables:
        for start, items in table.find(words):
            for item in items:
                own = runs.setdefault(item, [])
                if own and own[-1][0] <= start <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], start + table.length)
                else:
                    own.append([start, start + table.length])
    return [(item, start, stop) for item, own in runs.items() for start, stop in own]


def _passes(benchmark: DataFrame, item: str, text: str, pass_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark in blocks of at most ``pass_bytes``, or of one longer item."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    for row in rows.toLocalIterator():
        own = len((row.t or "").encode("utf-8", "surrogatepass"))
        if block and size + own > pass_bytes:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += own
    yield block


def _scan(block, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``n_words`` and ``found`` to batches whose first column is the text."""
    kind = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = searches(block.value, window)
        for batch in slices(batches):
            counts, found = [], []
            for text in batch.column(0):
                words = words_of(text.as_py())
                counts.append(len(words))
                found.append([{"item": i, "start": a, "stop": b} for i, a, b in hits_of(words, tables)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(counts, pa.int64()), pa.array(found, kind)],
                names=[*batch.schema.names[1:], "n_words", "found"])
    return scan


def _search(base: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, window: int,
            pass_bytes: int) -> DataFrame:
    """``base`` (text, doc_id, hash, ...) without its text, with ``n_words`` and ``found``."""
    broadcast = base.sparkSession.sparkContext.broadcast
    kept = T.StructType(base.schema.fields[1:]).add("n_words", "long").add("found", _FOUND)
    passes = [shipped(base).mapInArrow(_scan(broadcast(block), window), kept)
              for block in _passes(benchmark, item_id, item_text, pass_bytes)]
    first, *others = passes
    if not others:
        return first
    more = others[0]
    for other in others[1:]:
        more = more.unionByName(other)
    more = (more.where("size(found) > 0").groupBy("doc_id", "hash")
            .agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("more")))
    both = first.alias("a").join(more.alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.hash = b.hash"), "left")
    return both.select("a.*", "b.more").withColumn("found", F.expr("concat(found, coalesce(more, array()))")).drop("more")


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
               pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Rows of ``docs`` as (doc_id, n_words, found), ``found`` being the hits.

    A hit is (item, first word, end). One pass over the documents serves a block
    of the benchmark of at most ``pass_bytes``; it needs no shuffle. With more
    blocks, the hits of all passes are joined by id and text hash, and only rows
    with hits move.

    Null and empty texts have no words and no hits. Rows that repeat, and ids
    that repeat or are null, each give their row. Items of one id count as one
    item, null ids as one with an empty id. Without items nothing is hit. Other
    columns of either table are ignored.
    """
    base = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("hash"))
    return _search(base, benchmark, item_id, item_text, window, pass_bytes).drop("hash")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
               pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Rows of ``docs``, with all their columns, that share no window with an item.

    Each row is judged by its own text. Rows without words stay.
    """
    base = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("hash"), F.struct("*").alias("row"))
    return (_search(base, benchmark, item_id, item_text, window, pass_bytes)
            .where("size(found) = 0").select("row.*"))


def leak_report(leaks: DataFrame) -> DataFrame:
    """Hit words and items of every row of :func:`find_leaks`.

    A word that several hits cover counts once. ``items_sha256`` is over the
    item ids, sorted as strings.
    """
    # Hits in order of their start; the running end tells the words not counted yet.
    covered = """aggregate(array_sort(transform(found, f -> struct(f.start AS a, f.stop AS b))),
        struct(0L AS n, 0L AS upto),
        (acc, f) -> struct(acc.n + greatest(f.b - greatest(f.a, acc.upto), 0L) AS n,
                           greatest(acc.upto, CAST(f.b AS LONG)) AS upto),
        acc -> acc.n)"""
    items = "array_sort(array_distinct(transform(found, f -> f.item)))"
    return (leaks.withColumn("items", F.expr(items)).withColumn("n_hit", F.expr(covered))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))
