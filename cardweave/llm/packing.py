"""Packing token sequences by vector bin packing.

A sequence is a bin with three limits: tokens, segments, and loss-bearing
tokens. Bins are filled one after the other. Of the pieces that fit, the one
whose demands have the largest dot product with what the bin has left goes in.
Where no piece fits whole, the best one is cut to fill the bin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cardweave.llm.bpe import token_ids, with_end
from cardweave.llm.store import shipped, slices


@dataclass(frozen=True)
class Limits:
    """Limits of a sequence, and the pieces that a task holds while it packs."""

    tokens: int = 1024
    segments: int = 256
    loss: int = 1024
    pool: int = 1024


@dataclass
class Piece:
    """Ids ``start`` to ``stop`` of one document; the first ``prompt`` of its ids bear no loss."""

    doc: int | None
    ids: np.ndarray
    prompt: int
    start: int
    stop: int

    def loss(self, stop: int | None = None) -> int:
        return max(0, (self.stop if stop is None else stop) - max(self.start, self.prompt))

    def cut(self, tokens: int, loss: int) -> int:
        """Where a first part of at most so many tokens and loss-bearing tokens ends."""
        free = max(0, self.prompt - self.start)
        return min(self.stop, self.start + min(tokens, free + loss))


class Packer:
    """Fills sequences from a pool of pieces; ``out`` gets (sequence, offset, piece)."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.most = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pool: list[Piece] = []
        self.demand = np.zeros((0, 3))
        self.sequences = 0
        self.out: list[tuple[int, int, Piece]] = []

    def add(self, doc: int | None, ids: np.ndarray, prompt: int) -> None:
        """A document. Whole sequences are cut from it at once, the rest waits in the pool."""
        piece = Piece(doc, ids, prompt, 0, len(ids))
        while piece.stop - piece.start >= self.limits.tokens and piece.cut(
                self.limits.tokens, self.limits.loss) - piece.start == self.limits.tokens:
            self._close([self._first(piece, piece.start + self.limits.tokens)])
        if piece.stop > piece.start:
            self.pool.append(piece)
        if len(self.pool) >= self.limits.pool:
            self.pack(self.limits.pool // 2)

    @staticmethod
    def _first(piece: Piece, stop: int) -> Piece:
        part = Piece(piece.doc, piece.ids, piece.prompt, piece.start, stop)
        piece.start = stop
        return part

    def _close(self, parts: list[Piece]) -> None:
        """Write a bin; one that is not full becomes sequences of a power of two each."""
        sizes = [p.stop - p.start for p in parts]
        room = self.limits.tokens
        if sum(sizes) < room:
            room = 1 << (sum(sizes).bit_length() - 1)
        at, left = 0, sum(sizes)
        for part in parts:
            while part.start < part.stop:
                take = min(part.stop - part.start, room - at)
                self.out.append((self.sequences, at, self._first(part, part.start + take)))
                at, left = at + take, left - take
                if at == room:
                    self.sequences, at = self.sequences + 1, 0
                    room = 1 << (left.bit_length() - 1) if left else room

    def pack(self, keep: int) -> None:
        """Close bins until at most ``keep`` pieces wait."""
        if len(self.pool) <= keep:
            return
        demand = np.array([[p.stop - p.start, 1, p.loss()] for p in self.pool], float)
        alive = np.ones(len(self.pool), bool)
        # A dimension counts by the share of its limit that the pieces ask for.
        weight = demand.mean(axis=0) / self.most ** 2
        while alive.sum() > keep:
            left, parts = self.most.copy(), []
            while left[0] > 0 and left[1] > 0 and alive.any():
                score = np.where(alive, demand @ (weight * left), -1.0)
                fits = alive & (demand <= left).all(axis=1)
                if fits.any():
                    best = int(np.argmax(np.where(fits, score, -1.0)))
                    parts.append(self.pool[best])
                    left -= demand[best]
                    alive[best] = False
                    continue
                best = int(np.argmax(score))
                piece = self.pool[best]
                stop = piece.cut(int(left[0]), int(left[2]))
                if stop == piece.start:
                    break
                part = self._first(piece, stop)
                left -= (part.stop - part.start, 1, part.loss())
                demand[best] = piece.stop - piece.start, 1, piece.loss()
                parts.append(part)
                break  # the cut used up the tokens or the loss-bearing tokens
            self._close(parts)
        self.pool = [p for p, a in zip(self.pool, alive.tolist()) if a]

    def taken(self) -> list[tuple[int, int, Piece]]:
        out, self.out = self.out, []
        return out


def _rows(packed: list[tuple[int, int, Piece]], base: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([p.doc for _, _, p in packed], pa.int64()),
        pa.array([p.start for _, _, p in packed], pa.int64()),
        pa.array([p.stop - p.start for _, _, p in packed], pa.int64()),
        pa.array([p.ids[p.start:p.stop].astype("<u4").tobytes() for _, _, p in packed], pa.binary()),
        pa.array([len(p.ids) for _, _, p in packed], pa.int64()),
        pa.array([p.loss() for _, _, p in packed], pa.int64()),
        pa.array([base + s for s, _, _ in packed], pa.int64()),
        pa.array([o for _, o, _ in packed], pa.int64())],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"])


_PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, "
           "sequence_id long, offset long")


def _packing(limits: Limits, examples: Callable[[pa.RecordBatch], Iterator[tuple[int | None, np.ndarray, int]]]
             ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(limits), TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            for doc, ids, prompt in examples(batch):
                packer.add(doc, ids, prompt)
                if len(packer.out) >= 4096:
                    yield _rows(packer.taken(), base)
        packer.pack(0)
        yield _rows(packer.taken(), base)
    return pack


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pack ready ids: (doc_id, ids, prompt) to pieces.

    ``ids`` holds little-endian unsigned 32-bit integers, ``prompt`` is the number
    of leading ids that bear no loss (null: none). A piece is (doc_id, start,
    length, ids, doc_tokens, loss_tokens, sequence_id, offset). Each id lies in
    exactly one piece, and no sequence exceeds a limit. A bin that the limits or
    the end of the input leave unfilled is cut into sequences whose lengths are
    powers of two, so nothing is padded.

    Every task packs its own partition; there is no shuffle, and sequence ids are
    distinct across tasks. Empty and null ids give no piece. Ids that repeat or
    are null are packed like others.
    """
    def read(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray, int]]:
        for doc, ids, prompt in zip(*(batch.column(i).to_pylist() for i in range(3))):
            yield doc, np.frombuffer(ids or b"", "<u4"), max(0, prompt or 0)
    rows = examples.select(F.col("doc_id").cast("long"), "ids", F.col("prompt").cast("long"))
    return shipped(rows).mapInArrow(_packing(limits, read), _PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, *, end_id: int, doc_id: str = "doc_id", text: str = "text",
                   limits: Limits = Limits()) -> DataFrame:
    """Encode whole texts, end each with ``end_id``, and pack them as :func:`pack_examples` does.

    Null and empty texts are the end id alone. Other columns are ignored.
    """
    def read(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray, int]]:
        ids, counts = with_end(*token_ids(tokenizer).encode(batch.column(1).to_pylist()), end_id)
        for doc, own in zip(batch.column(0).to_pylist(), np.split(ids, np.cumsum(counts)[:-1])):
            yield doc, own, 0
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return shipped(rows).mapInArrow(_packing(limits, read), _PIECES)
