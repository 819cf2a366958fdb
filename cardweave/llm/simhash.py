"""SimHash near-duplicates: fingerprints, and links by meet-in-the-middle balls.

Two fingerprints that differ in at most four bits have a value in common that
differs in at most two bits from either. Every distinct fingerprint therefore
emits all 2,081 values within two bits, and fingerprints that emit one value are
linked. The values are not moved one by one: a value belongs to the partition of
its leading bits, each fingerprint goes once to every partition in which it has
values, and these are written out and matched there, a slice at a time.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cardweave.llm.components import components
from cardweave.llm.store import shipped, slices, stored

#: Words of a shingle.
SHINGLE = 4
SEED = 42
#: Differing bits at which fingerprints still link, and half of it.
RADIUS = 4
HALF = RADIUS // 2
#: Values that a partition holds on average, and at most at a time.
PARTITION_VALUES = 1 << 20
SLICE_VALUES = 1 << 22

_ONE = np.uint64(1)


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a whole text; 0 if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    last = max(1, len(words) - SHINGLE + 1)
    stops = (ends[SHINGLE - 1:] - 1).tolist() if len(words) >= SHINGLE else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:last], stops)), np.uint64, last)
    votes = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 16):  # bounds the bit table of very long texts
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > last, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        bits = np.fromiter((fingerprint(t.as_py()) for t in batch.column(0)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(bits.view(np.int64))],
                                         names=[*batch.schema.names[1:], "bits"])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, bits) of every row, ``bits`` being the fingerprint as a signed long."""
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    return shipped(rows).mapInArrow(_fingerprints, "doc_id long, bits long")


def _flips(bits: int, most: int) -> list[int]:
    """All masks of at most ``most`` of the lowest ``bits`` bits."""
    return [sum(1 << b for b in chosen) for k in range(most + 1) for chosen in itertools.combinations(range(bits), k)]


def _ball(prints: np.ndarray, lead: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """Values within HALF bits of a fingerprint whose ``lead`` leading bits are ``prefix``, and their fingerprints."""
    rest = 64 - lead
    low = prints & np.uint64((1 << rest) - 1) if rest else np.zeros_like(prints)
    high = np.uint64(prefix << rest)
    off = np.bitwise_count((prints ^ high) >> np.uint64(rest)) if lead else np.zeros(len(prints), np.uint8)
    values, owners = [], []
    for spent in range(HALF + 1):
        own = np.flatnonzero(off == spent)
        if len(own):
            masks = np.array(_flips(rest, HALF - spent), np.uint64)
            values.append(((low[own] | high)[:, None] ^ masks[None, :]).reshape(-1))
            owners.append(np.repeat(own, len(masks)))
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(values), np.concatenate(owners)


def _ball_size(prints: np.ndarray, lead: int, prefix: int) -> int:
    rest = 64 - lead
    off = np.bitwise_count((prints ^ np.uint64(prefix << rest)) >> np.uint64(rest)) if lead else np.zeros(len(prints))
    sizes = [1 + rest + rest * (rest - 1) // 2, 1 + rest, 1]
    return sum(int((off == k).sum()) * size for k, size in enumerate(sizes))


def _slice_links(prints: np.ndarray, lead: int, prefix: int) -> np.ndarray:
    """Pairs (i, j) of fingerprints that share a value, each with the first of its value's fingerprints."""
    values, owners = _ball(prints, lead, prefix)
    ascending = np.sort(values)
    shared = np.unique(ascending[1:][ascending[1:] == ascending[:-1]])
    if not len(shared):
        return np.zeros((0, 2), np.int64)
    # A table of one bit a value leaves few candidates for the exact comparison.
    mixed = lambda v: (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
    mark = np.zeros(1 << 20, bool)
    mark[mixed(shared)] = True
    maybe = np.flatnonzero(mark[mixed(values)])
    spot = np.minimum(np.searchsorted(shared, values[maybe]), len(shared) - 1)
    hit = shared[spot] == values[maybe]
    spot, owner = spot[hit], owners[maybe][hit]
    first = np.full(len(shared), len(prints))
    np.minimum.at(first, spot, owner)
    pairs = np.stack([first[spot], owner], axis=1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    near = np.bitwise_count(prints[pairs[:, 0]] ^ prints[pairs[:, 1]]) <= RADIUS
    return pairs[near]


def _links(prints: np.ndarray, lead: int, prefix: int) -> Iterator[np.ndarray]:
    """As _slice_links, in slices that fit in memory."""
    if lead < 62 and _ball_size(prints, lead, prefix) > SLICE_VALUES:
        for bit in (0, 1):
            yield from _links(prints, lead + 1, 2 * prefix + bit)
    else:
        yield _slice_links(prints, lead, prefix)


def _forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least node that it is linked with, directly or not."""
    root = np.arange(n)
    while True:
        a, b = root[pairs[:, 0]], root[pairs[:, 1]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _matching(lead: int):
    def match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        prints = np.unique(table.column("bits").to_numpy().view(np.uint64))
        root = np.arange(len(prints))
        for pairs in _links(prints, lead, key[0].as_py()):
            pairs = np.concatenate([pairs, np.stack([root, np.arange(len(prints))], axis=1)])
            root = _forest(len(prints), pairs)
        tied = np.flatnonzero(root != np.arange(len(prints)))
        return pa.table({"a": pa.array(prints[root[tied]].view(np.int64)), "b": pa.array(prints[tied].view(np.int64))})
    return match


def ball_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within RADIUS bits.

    ``distinct`` holds each fingerprint once, as ``bits``. A partition returns a
    forest of its links, so a group of many near copies gives no more links
    than it has members.
    """
    values = distinct.count() * len(_flips(64, HALF))
    lead = min(24, max(1, (values // PARTITION_VALUES).bit_length()))
    partition = F.shiftrightunsigned("bits", 64 - lead).cast("int")
    dealt = distinct.select("bits", F.explode(F.array(*map(F.lit, _flips(lead, HALF)))).alias("flip")).select(
        partition.bitwiseXOR(F.col("flip")).alias("part"), "bits")
    return shipped(dealt).groupBy("part").applyInArrow(_matching(lead), "a long, b long")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest id of the rows that can be reached over
    links of at most four differing bits. Texts without words, null ones too,
    have fingerprint 0 and are linked like others. Repeated rows and ids give a
    row each. A null id is never the smallest; where all ids of a component are
    null, so is ``component_id``. An empty table gives an empty result. Other
    columns are ignored.
    """
    prints = stored(fingerprints(docs, doc_id=doc_id, text=text))
    # One row a distinct fingerprint from here on, however many copies there are.
    members = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("least")))
    rooted = _rooted(members)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("bits", "component_id")
    return prints.join(named, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def _rooted(members: DataFrame) -> DataFrame:
    """``members``, one row a fingerprint, with ``root``, a fingerprint that stands for its component."""
    roots = components(ball_links(members.select("bits"))).withColumnRenamed("node", "bits")
    return stored(members.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits")))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs``, with all columns, of each component: that of the smallest id.

    Of rows that share the smallest id one stays, that whose text has the smallest
    hash. A row with a null id stays only where all ids of its component are null.
    """
    rows = stored(docs.withColumn("__one_row", F.monotonically_increasing_id()))
    keyed = rows.select(F.col(text).alias("text"), F.struct(
        F.col(doc_id).isNull().alias("none"), F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("hash"),
        F.col("__one_row").alias("row")).alias("first"))
    kind = "first struct<none:boolean,id:long,hash:long,row:long>, bits long"
    prints = stored(shipped(keyed).mapInArrow(_fingerprints, kind))
    members = stored(prints.groupBy("bits").agg(F.min("first").alias("first")))
    kept = _rooted(members).groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(kept.select(F.col("first.row").alias("__one_row")), "__one_row", "left_semi").select(*docs.columns)
