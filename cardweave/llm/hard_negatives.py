"""Hard negatives by bounds that run down a spanning tree of anchors.

Anchors are dealt into groups, and each group's anchors are linked by a minimum
spanning tree. A candidate's score at an anchor differs from that at the anchor's
parent by at most the length of the edge times the candidate's norm. So the score
at the parent, or the bounds on it, bound the score at the child, and only candidates
whose bounds overlap a window in which a result can lie are scored anew. First the
positives of all anchors are found, whose scores then give the windows of the
negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardweave.llm.store import shipped, stored
from cardweave.llm.vectors import PASS_BYTES, finite, matrix, one_row_an_id, parts

#: Anchors of a tree, on average.
TREE_ANCHORS = 512
#: Candidates whose bounds are held at a time, for all anchors of a tree.
BLOCK_ROWS = 2048

_TREE = "tree int, spot int, vec_id long, label int, v array<long>, parent int, edge double"


def _exact(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors; what passes 64 bits stops at the last long."""
    if rows.dtype != object:
        return (rows @ anchor).astype(np.int64)
    return np.array([max(-2 ** 63, min(2 ** 63 - 1, score)) for score in rows.dot(anchor.astype(object))], np.int64)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order in which a minimum spanning tree grows from the first point; by place in it the parent's place (-1) and the edge."""
    n = len(points)
    order, parent, edge = np.zeros(n, int), np.full(n, -1), np.zeros(n)
    near, by = np.full(n, np.inf), np.zeros(n, int)
    left = np.ones(n, bool)
    now = 0
    for place in range(n):
        order[place], left[now] = now, False
        if place:
            parent[place], edge[place] = by[now], near[now]
        length = np.sqrt(((points - points[now]) ** 2).sum(axis=1))
        closer = left & (length < near)
        near[closer], by[closer] = length[closer], place
        now = int(np.argmin(np.where(left, near, np.inf)))
    return order, parent, edge


def _plant(width: int) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    def plant(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        order, parent, edge = spanning_tree(matrix(table.column("v").combine_chunks(), width, np.float64))
        table = table.take(pa.array(order))
        return pa.table({"tree": table.column("tree"), "spot": pa.array(np.arange(len(order)), pa.int32()),
                         "vec_id": table.column("vec_id"), "label": table.column("label"), "v": table.column("v"),
                         "parent": pa.array(parent, pa.int32()), "edge": pa.array(edge)})
    return plant


@dataclass
class Trees:
    """Anchors of a pass, tree by tree; parents count from the tree's first anchor."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    starts: list[int]       # first anchor of each tree, and the end
    windows: list           # positives of each anchor: (id, score), empty while they are sought


class _Best:
    """The ``k`` best candidates met so far: highest score, then smallest id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = -np.inf

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids):
            self.ids, self.scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
            best = np.lexsort((self.ids, ~self.scores))[:self.k]
            self.ids, self.scores = self.ids[best], self.scores[best]
            if len(best) == self.k:
                self.least = float(self.scores[-1])


class _Positives:
    """What an anchor looks for: the best others of its own label."""

    def __init__(self, anchor: int, label: int, window: list, k: int):
        self.anchor, self.label, self.best = anchor, label, _Best(k)

    def wanted(self, labels: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (labels == self.label) & (ids != self.anchor) & (high >= self.best.least)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        self.best.add(ids, scores)

    def found(self) -> list[tuple[int, int, _Best]]:
        return [(0, 0, self.best)]


class _Negatives:
    """The best of other labels in the window below each positive."""

    def __init__(self, anchor: int, label: int, window: list, k: int, share: int = 80):
        self.label, self.share = label, share
        self.lists = [(positive, score, _Best(k)) for positive, score in window if score >= 0]

    def wanted(self, labels: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), bool)
        for _, score, best in self.lists:
            out |= (high >= max(self.share * score / 100 * (1 - 1e-12), best.least)) & (low <= score)
        return out & (labels != self.label)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for _, score, best in self.lists:
            own = (scores >= -(-self.share * score // 100)) & (scores <= score)
            best.add(ids[own], scores[own])

    def found(self) -> list[tuple[int, int, _Best]]:
        return self.lists


def _search(trees, width: int, k: int, kind: type, count: dict | None = None
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidates of a task against all anchors of a pass. ``count`` gets the scores bounded and computed, for tests."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = trees.value
        seekers = [kind(a, b, c, k) for a, b, c in zip(t.ids.tolist(), t.labels.tolist(), t.windows)]
        reach = float(np.sqrt((t.points.astype(float) ** 2).sum(axis=1)).max(initial=0.0))
        size = float(np.abs(t.points).max(initial=0))
        for batch in parts(batches, BLOCK_ROWS):
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            whole = matrix(batch.column(2), width, np.int64)
            x, points = whole.astype(float), t.points.astype(float)
            if size * float(np.abs(x).max(initial=0)) * width >= 2 ** 53:  # beyond what doubles hold
                exact_rows, exact_points = whole.astype(object), t.points
            else:
                exact_rows, exact_points = x, points
            norms = np.sqrt((x ** 2).sum(axis=1))
            slack = norms * reach * 1e-9
            for start, stop in zip(t.starts[:-1], t.starts[1:]):
                lows, highs = np.empty((stop - start, len(ids))), np.empty((stop - start, len(ids)))
                for at in range(stop - start):
                    anchor, up = start + at, t.parent[start + at]
                    if up < 0:
                        low, high = np.full(len(ids), -np.inf), np.full(len(ids), np.inf)
                        own = np.arange(len(ids))
                        wanted = seekers[anchor].wanted(labels, ids, low, high)
                    else:
                        step = t.edge[anchor] * norms + slack
                        low, high = lows[up] - step, highs[up] + step
                        wanted = seekers[anchor].wanted(labels, ids, *np.clip((low, high), -2.0 ** 63, 2.0 ** 63))
                        own = np.flatnonzero(wanted)
                    if count is not None:
                        count["bounded"] = count.get("bounded", 0) + len(ids)
                        count["scored"] = count.get("scored", 0) + len(own)
                    if len(own):
                        scores = _exact(exact_rows if len(own) == len(ids) else exact_rows[own], exact_points[anchor])
                        if exact_rows.dtype == object:  # widened by what rounding may take
                            near = x[own] @ points[anchor]
                            low[own], high[own] = near - slack[own], near + slack[own]
                        else:
                            low[own] = high[own] = scores
                        hit = wanted[own]
                        seekers[anchor].add(ids[own][hit], scores[hit])
                    lows[at], highs[at] = low, high
        for anchor, seeker in zip(t.ids.tolist(), seekers):
            for positive, score, best in seeker.found():
                n = len(best.ids)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, anchor)), pa.array(np.full(n, positive)), pa.array([score] * n, pa.int64()),
                         pa.array(best.ids), pa.array(best.scores)],
                        names=["anchor_id", "positive_id", "positive_score", "found_id", "found_score"])
    return search


_FOUND = "anchor_id long, positive_id long, positive_score long, found_id long, found_score long"


def _passes(planted: DataFrame, number: int, each: int, width: int) -> Iterator[Trees]:
    """Trees in passes of ``each``."""
    for first in range(0, number, each):
        rows = planted.where(F.col("tree").between(first, first + each - 1)).orderBy("tree", "spot").toArrow()
        if rows.num_rows:
            column = {name: rows.column(name).combine_chunks() for name in rows.column_names}
            spot = column["spot"].to_numpy()
            windows = [[(w["id"], w["score"]) for w in own or []] for own in
                       (column["window"].to_pylist() if "window" in column else [None] * len(spot))]
            yield Trees(column["vec_id"].to_numpy(), column["label"].to_numpy(), matrix(column["v"], width, np.int64),
                        column["parent"].to_numpy(), column["edge"].to_numpy(),
                        [*np.flatnonzero(spot == 0).tolist(), len(spot)], windows)


def _all(rows: DataFrame, planted: DataFrame, number: int, each: int, width: int, k: int, kind: type) -> DataFrame:
    broadcast = rows.sparkSession.sparkContext.broadcast
    found = None
    for trees in _passes(planted, number, each, width):
        part = rows.mapInArrow(_search(broadcast(trees), width, k, kind), _FOUND)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("found_score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                        anchor: Column | None = None, scale: int = 256, positives: int = 5, negatives: int = 5,
                        tree_anchors: int = TREE_ANCHORS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of two vectors whose components x are taken as ``floor(scale * x)``;
    ties go to the smaller id. ``anchor`` says which rows are anchors, on the column ``vec_id``; unset,
    those whose id is divisible by 100. An anchor's positives are its best other rows of the same label.
    Its negatives are, for each positive, the best rows of another label that score at most as much as
    the positive and at least 80 percent of it; a positive with a score below zero has none.

    Rows without id, label or vector, and vectors with a null or non-finite component, take no part. Of
    rows with one id that with the least label and vector does. A shorter vector ends in zeros.
    Components beyond 64 bits stop at the last long, scores too. Without anchors the result is empty.

    Every anchor is held against every row, as the result asks for; what does not overlap a window is
    not scored. Rows stay in their tasks. Anchors are broadcast in passes of about ``pass_bytes``, each
    of which reads the rows once, and tasks return their best rows only. Other columns are ignored.
    """
    anchor = F.col("vec_id") % 100 == 0 if anchor is None else anchor
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    kept = vectors.where(finite(F.col(vector)) & F.col(label).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"), whole.alias("v"))
    rows = stored(one_row_an_id(kept, "vec_id"))
    spark = rows.sparkSession
    width, anchors = rows.agg(F.max(F.size("v")), F.count_if(anchor)).first()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    if not anchors:
        return empty
    number = -(-anchors // tree_anchors)
    each = max(1, pass_bytes // (tree_anchors * (8 * width + 256)))
    shipped(rows)
    planted = stored(rows.where(anchor).withColumn("tree", F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int"))
                     .groupBy("tree").applyInArrow(_plant(width), _TREE))
    best = _all(rows, planted, number, each, width, positives, _Positives)
    windows = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank"), F.col("found_id").alias("id"), F.col("found_score").alias("score")))).alias("window"))
    planted = stored(planted.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left"))
    found = _all(rows, planted, number, each, width, negatives, _Negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
                        F.col("found_score").alias("negative_score"))

