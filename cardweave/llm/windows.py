"""Windows of consecutive units that occur in an earlier document.

Documents are dealt into groups of some megabytes by a hash. A group sends the
hash of each of its distinct windows, with the smallest id that has it there,
to the bucket of that hash; so a window that very many documents share crosses
the network once a group. A bucket finds the smallest id of each hash and answers
with the windows for which another group has a smaller one. Groups then mark
the covered units of their documents.

Windows are told apart by 80 bits: a 64-bit hash, and 16 bits of a second one that
only windows with the same first hash are compared by. What moves are packed
blocks, one for each group and bucket, of about ten bytes a window, and the texts
once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cardweave.llm.store import shipped, text_bytes

#: UTF-8 bytes of the texts of a group, on average.
GROUP_BYTES = 6 << 20
#: Windows that a bucket compares, on average.
BUCKET_WINDOWS = 1 << 21

#: Stands for a null id: no id is larger.
_LAST = np.int64(2 ** 63 - 1)
# Odd bases of the two polynomials that hash a window of unit hashes.
_BASE, _SECOND_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_SENT = "bucket int, grp int, hashes binary, checks binary, owners binary, ids binary"
_REPLY = "grp int, bucket int, found binary"


@dataclass(frozen=True)
class Units:
    """Units of the texts of a group: ``split`` gives a text's, ``hashes`` hashes many."""

    split: Callable[[str | None], list]
    hashes: Callable[[list], np.ndarray]
    width: int
    #: whether later occurrences within one document count as well
    within: bool


@dataclass
class Group:
    """Windows of a group's documents, in ascending order of ids."""

    rows: np.ndarray      # row of the group's table, by document
    ids: np.ndarray       # id, by document
    units: list           # units of all documents in a row
    ends: np.ndarray      # where a document's units end
    starts: np.ndarray    # first unit, by window
    owner: np.ndarray     # document, by window
    distinct: np.ndarray  # hashes, ascending
    first: np.ndarray     # first window, by distinct hash
    which: np.ndarray     # distinct hash, by window
    checks: np.ndarray    # bits of the second hash, by distinct hash


def _rolled(unit: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Polynomial of every ``width`` consecutive unit hashes, modulo 2**64."""
    n = len(unit) - width + 1
    out = unit[:n].copy()
    for k in range(1, width):
        out *= base
        out += unit[k:n + k]
    return out


def _group(table: pa.Table, kind: Units) -> Group:
    ids = table.column("id").fill_null(int(_LAST)).to_numpy()
    rows = np.argsort(ids, kind="stable")
    texts, units, ends = table.column("text"), [], []
    for row in rows.tolist():
        units += kind.split(texts[row].as_py())
        ends.append(len(units))
    ends = np.array(ends, np.int64)
    n = len(units) - kind.width + 1
    rolled = second = np.zeros(0, np.uint64)
    starts = owner = np.zeros(0, np.int64)
    if n > 0:
        unit = kind.hashes(units)
        document = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        starts = np.flatnonzero(document[:n] == document[kind.width - 1:])
        owner = document[starts]
        rolled, second = (_rolled(unit, kind.width, base)[starts] for base in (_BASE, _SECOND_BASE))
    distinct, first, which = np.unique(rolled, return_index=True, return_inverse=True)
    checks = (second[first] >> np.uint64(48)).astype("<u2")
    return Group(rows, ids[rows], units, ends, starts, owner, distinct, first, which, checks)


def _cuts(distinct: np.ndarray, bits: int) -> np.ndarray:
    """Where the hashes of each bucket begin, and where the last ends."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])


def _planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes, and so on: zero bytes compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _values(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def _send(kind: Units, bits: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = _group(table, kind)
        cuts = _cuts(group.distinct, bits)
        out = {"bucket": [], "hashes": [], "checks": [], "owners": [], "ids": []}
        owner = group.owner[group.first]
        for bucket in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[bucket], cuts[bucket + 1])
            docs, at = np.unique(owner[own], return_inverse=True)
            out["bucket"].append(bucket)
            out["hashes"].append(_planes(np.diff(group.distinct[own], prepend=np.uint64(0))))
            out["checks"].append(_planes(group.checks[own]))
            out["owners"].append(_planes(at.astype("<u4")))
            out["ids"].append(_planes(np.diff(group.ids[docs], prepend=np.int64(0))))
        n = len(out["bucket"])
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()),
                         "grp": pa.array([key[0].as_py()] * n, pa.int32()),
                         "hashes": pa.array(out["hashes"], pa.binary()),
                         "checks": pa.array(out["checks"], pa.binary()),
                         "owners": pa.array(out["owners"], pa.binary()),
                         "ids": pa.array(out["ids"], pa.binary())})
    return send


def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    hashes = [np.cumsum(_values(x.as_py(), "<u8"), dtype=np.uint64) for x in table.column("hashes")]
    checks = np.concatenate([_values(x.as_py(), "<u2") for x in table.column("checks")])
    owners = [np.cumsum(_values(ids.as_py(), "<i8"), dtype=np.int64)[_values(at.as_py(), "<u4")]
              for ids, at in zip(table.column("ids"), table.column("owners"))]
    sizes = [len(h) for h in hashes]
    every, owner = np.concatenate(hashes), np.concatenate(owners)
    # Only hashes that two groups sent can be answered; the others need no pairing up.
    ascending = np.sort(every)
    shared = np.unique(ascending[1:][ascending[1:] == ascending[:-1]])
    mark = np.zeros(1 << 20, bool)
    mark[(shared >> np.uint64(20)) & np.uint64((1 << 20) - 1)] = True
    maybe = np.flatnonzero(mark[(every >> np.uint64(20)) & np.uint64((1 << 20) - 1)])
    spot = np.searchsorted(shared, every[maybe])
    spot[spot == len(shared)] = 0
    hit = shared[spot] == every[maybe] if len(shared) else np.zeros(len(maybe), bool)
    at = maybe[hit]
    same, spot = np.unique(spot[hit] << 16 | checks[at], return_inverse=True)
    least = np.full(len(same), _LAST)
    np.minimum.at(least, spot, owner[at])
    later = at[owner[at] > least[spot]]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    found = np.split(later, np.searchsorted(later, begins[1:-1]))
    groups = table.column("grp").to_pylist()
    rows = [(g, (f - b).astype("<u4").tobytes()) for g, f, b in zip(groups, found, begins.tolist()) if len(f)]
    return pa.table({"grp": pa.array([g for g, _ in rows], pa.int32()),
                     "bucket": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                     "found": pa.array([f for _, f in rows], pa.binary())})


def covered(group: Group, kind: Units, bits: int, replies: pa.Table) -> np.ndarray:
    """By unit: whether a window that starts earlier elsewhere covers it."""
    cuts = _cuts(group.distinct, bits)
    elsewhere = np.zeros(len(group.distinct), bool)
    for bucket, found in zip(replies.column("bucket").to_pylist(), replies.column("found").to_pylist()):
        elsewhere[cuts[bucket] + np.frombuffer(found, "<u4").astype(np.int64)] = True
    leader = group.first[group.which]
    repeat = elsewhere[group.which] | (group.ids[group.owner] > group.ids[group.owner[leader]])
    if kind.within:
        # The first window of each hash in its own document stays.
        order = np.lexsort((group.starts, group.owner, group.which))
        same = (np.diff(group.which[order], prepend=-1) == 0) & (np.diff(group.owner[order], prepend=-1) == 0)
        repeat[order[same]] = True
    steps = np.zeros(len(group.units) + 1, np.int64)
    np.add.at(steps, group.starts[repeat], 1)
    np.add.at(steps, group.starts[repeat] + kind.width, -1)
    return np.cumsum(steps[:-1]) > 0


def mark_repeats(docs: DataFrame, kind: Units, finish: Callable[[pa.Table, Group, np.ndarray], pa.Table],
                 schema: T.StructType | str, *, doc_id: str, text: str, carried: list[str],
                 unit_bytes: int) -> DataFrame:
    """``finish(table, group, covered)`` for every group; ``table`` has id, text and the struct ``rest``.

    ``carried`` names the columns of ``rest``. ``unit_bytes`` is a unit's usual
    size, from which the number of buckets follows.
    """
    size = text_bytes(docs, text)
    groups = max(1, -(-size // GROUP_BYTES))
    bits = max(0, (size // (unit_bytes * BUCKET_WINDOWS)).bit_length())
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(doc_id).cast("long"), F.col(text)), F.lit(groups)).cast("int").alias("grp"),
        F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in carried] or [F.lit(None).cast("int").alias("none")]).alias("rest"))
    rows = shipped(rows)
    replies = rows.groupBy("grp").applyInArrow(_send(kind, bits), _SENT).groupBy("bucket").applyInArrow(_answer, _REPLY)

    def last(own: pa.Table, answers: pa.Table) -> pa.Table:
        group = _group(own, kind)
        return finish(own, group, covered(group, kind, bits, answers))
    return rows.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(last, schema)
