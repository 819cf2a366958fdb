"""Token ids as bit-packed files.

A file set is a folder of Parquet files whose rows are blocks. A block holds
whole documents in order and is readable by itself:

    shard      number of the writing task, ascending with the documents' order
    block      number of the block within its shard
    first      ids of the shard before this block (the block's offset)
    n_ids      ids in the block
    bits       bits of an id, the least that hold the vocabulary
    docs       document ids
    ends       where each document ends, in ids from the block's start
    payload    ids of ``bits`` bits each, lowest bit first, in little-endian
               64-bit words and padded to a whole word

Spark's writer commits the rows, so a task that runs again leaves no half file,
and the folder may lie in any store that Spark can write to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardweave.llm.bpe import token_ids, with_end
from cardweave.llm.store import shipped, slices

#: Shards, thus tasks that wrote, up to which their offsets (16 bytes each) are broadcast.
BROADCAST_SHARDS = 200_000
#: Ids after which a block is closed at the end of a document.
BLOCK_IDS = 1 << 16

_BLOCKS = ("shard int, block long, first long, n_ids long, bits int, docs array<long>, ends array<long>, "
           "payload binary")


def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids below ``2 ** bits`` (at most 32 bits) in a row, without gaps."""
    n = len(ids)
    lanes = np.zeros((-(-n // 64), 64), np.uint64)
    lanes.reshape(-1)[:n] = ids
    words = np.zeros((len(lanes), bits), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.reshape(-1)[:-(-n * bits // 64)].astype("<u8").tobytes()


def unpack_bits(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start``; only their words are looked at."""
    if count <= 0:
        return np.zeros(0, np.uint32)
    first = start * bits // 64
    last = -(-(start + count) * bits // 64)
    words = np.append(np.frombuffer(payload, "<u8", last - first, first * 8), np.uint64(0))
    at = np.arange(count, dtype=np.int64) * bits + (start * bits - first * 64)
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    low = words[word] >> shift
    high = (words[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
    return ((low | high) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _encode(path: str, end_id: int, block_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(path)
        bits = bits_for(max(encoder.vocabulary, end_id + 1))
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            ids, ends = np.concatenate(parts), np.cumsum(np.concatenate(sizes))
            row = {"shard": shard, "block": block, "first": first, "n_ids": len(ids), "bits": bits,
                   "docs": docs, "ends": ends.tolist(), "payload": pack_bits(ids, bits)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()),
                            ("n_ids", pa.int64()), ("bits", pa.int32()), ("docs", pa.list_(pa.int64())),
                            ("ends", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in slices(batches):
            ids, counts = with_end(*encoder.encode(batch.column(1).to_pylist()), end_id)
            ends, names, at = np.cumsum(counts), batch.column(0).to_pylist(), 0
            while at < len(names):
                before = ends[at] - counts[at]
                room = block_ids - sum(map(len, parts))
                stop = min(len(names), int(np.searchsorted(ends, before + room)) + 1)
                docs += names[at:stop]
                parts.append(ids[before:ends[stop - 1]])
                sizes.append(counts[at:stop])
                at = stop
                if sum(map(len, parts)) >= block_ids:
                    done = closed()
                    yield done
                    first, block = first + done.column(3)[0].as_py(), block + 1
                    docs, parts, sizes = [], [], []
        if docs:
            yield closed()
    return encode


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, end_id: int, doc_id: str = "doc_id",
                      text: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the ids, in ascending order of the ids of documents.

    ``end_id`` follows each document. Null and empty texts are that id alone.
    Null document ids come last; rows with equal ids follow each other in the
    order of their rows and may lie in different shards. One shuffle sorts the
    documents into shards. An empty table gives an empty folder. Other columns
    are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.monotonically_increasing_id().alias("tie"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    shipped(ordered).mapInArrow(_encode(tokenizer, end_id, block_ids), _BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the ids of all blocks before."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    # One row a shard, so the window over all of them holds as many rows as tasks wrote.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    if sizes.limit(BROADCAST_SHARDS + 1).count() <= BROADCAST_SHARDS:
        bases = F.broadcast(bases)  # else the payloads move to their offsets
    return blocks.join(bases, "shard").withColumn("start", F.col("base") + F.col("first")).drop("base")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):  # one block's payload at a time
            row = batch.slice(at, 1).to_pylist()[0]
            ends = np.array(row["ends"], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            ids = unpack_bits(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["docs"], pa.int64()), pa.array(starts + row["start"]), pa.array(ends - starts),
                 pa.array([ids[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file set: (doc_id, start, n_tokens, ids).

    ``start`` counts the ids of all documents before, ``ids`` holds little-endian
    unsigned 32-bit integers.
    """
    blocks = read_blocks(spark, path).select("start", "n_ids", "bits", "docs", "ends", "payload")
    return shipped(blocks).mapInArrow(_unpack, "doc_id long, start long, n_tokens long, ids binary")


def read_range(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` of the whole set, for random access.

    Reads the payload of the blocks that hold them only.
    """
    stop = start + count
    rows = (read_blocks(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
            .select("start", "n_ids", "bits", "payload").orderBy("start"))
    parts = []
    for row in rows.toLocalIterator():
        low, high = max(start, row.start) - row.start, min(stop, row.start + row.n_ids) - row.start
        parts.append(unpack_bits(row.payload, row.bits, low, high - low))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
