"""Approximate nearest neighbours by a forest of random-projection trees.

A node parts its vectors at the median of their projections on the difference
of two random ones. All trees of the forest are searched through one priority
queue: the side of a plane that a query lies on goes in with the least distance
to a plane on the way, the other side with the negative of it, and the best node
of any tree is opened next, until the opened leaves hold enough rows. All rows of
these leaves are ranked by their exact distances.

The planes are fitted on a bounded sample; every row is put into a leaf of every
tree. Rows do not move: a task ranks its own rows for all queries that opened
their leaves and returns its nearest ones, which are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardweave.llm.store import shipped, stored
from cardweave.llm.vectors import PASS_BYTES, finite, matrix, one_row_an_id, parts

#: Rows that the planes are fitted on at most.
SAMPLE_ROWS = 1 << 14
#: Rows of a leaf, and sample rows below which no node is parted.
LEAF_ROWS, LEAF_SAMPLE = 64, 8
TREES = 16
#: Rows of the leaves that a query opens, as a share of all rows, summed over the trees.
OPENED = 1.6
#: Rows that are ranked at a time.
BLOCK_ROWS = 4096


@dataclass
class Forest:
    """Nodes of all trees. A child below zero is leaf ``-1 - child``; leaves are numbered over all trees."""

    planes: np.ndarray    # unit normal, by node
    offsets: np.ndarray   # position of the plane
    children: np.ndarray  # (node, 2): at or below the plane, above it
    roots: list[int]
    sizes: np.ndarray     # share of the sample, by leaf

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(row, tree): leaf of every row."""
        out = np.empty((len(x), len(self.roots)), np.int32)
        for tree, root in enumerate(self.roots):
            node = np.full(len(x), root)
            while len(at := np.flatnonzero(node >= 0)):
                own = node[at]
                side = np.einsum("ij,ij->i", x[at], self.planes[own]) > self.offsets[own]
                node[at] = self.children[own, side.astype(np.int64)]
            out[:, tree] = -1 - node
        return out

    def opened(self, queries: np.ndarray, share: float) -> list[np.ndarray]:
        """Leaves that each query opens, best first, until they hold ``share`` of the rows."""
        planes, children, sizes = self.planes, self.children.tolist(), self.sizes.tolist()
        found = []
        for query in queries:
            margin = (planes @ query - self.offsets).tolist() if len(planes) else []
            queue = [(-np.inf, root) for root in self.roots]
            heapq.heapify(queue)
            own, held = [], 0.0
            while queue and held < share:
                worst, node = heapq.heappop(queue)
                if node < 0:
                    own.append(-1 - node)
                    held += sizes[-1 - node]
                    continue
                at = margin[node]
                low, high = children[node]
                heapq.heappush(queue, (max(worst, at), low))
                heapq.heappush(queue, (max(worst, -at), high))
            found.append(np.array(own, np.int32))
        return found


def fit_forest(sample: np.ndarray, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
               leaf_sample: int = LEAF_SAMPLE) -> Forest:
    """Planes from a sample of ``rows`` rows. Nodes whose sample does not part are leaves."""
    random = np.random.default_rng(13)
    least = max(leaf_sample, leaf_rows * len(sample) / max(1, rows))
    planes, offsets, children, roots, sizes = [], [], [], [], []

    def grow(own: np.ndarray) -> int:
        """The node's number; the depth is logarithmic, as each side gets half."""
        if len(own) > least:
            for _ in range(3):
                a, b = sample[random.choice(own, 2, replace=False)]
                length = np.linalg.norm(a - b)
                if length > 0:
                    normal = (a - b) / length
                    at = sample[own] @ normal
                    cut = np.median(at)
                    above = at > cut
                    if 4 * above.sum() > len(own):
                        node = len(planes)
                        planes.append(normal)
                        offsets.append(cut)
                        children.append([0, 0])
                        children[node] = [grow(own[~above]), grow(own[above])]
                        return node
        sizes.append(len(own) / max(1, len(sample)))
        return -len(sizes)

    for _ in range(trees):
        roots.append(grow(np.arange(len(sample))))
    width = sample.shape[1] if sample.ndim == 2 else 0
    return Forest(np.array(planes, float).reshape(-1, width), np.array(offsets, float),
                  np.array(children, np.int64).reshape(-1, 2), roots, np.array(sizes))


def _open(forest, width: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BLOCK_ROWS):
            found = forest.value.opened(matrix(batch.column(1), width, np.float64), share)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([own.tobytes() for own in found], pa.binary())], names=["vec_id", "v", "leaves"])
    return search


def _index(forest, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BLOCK_ROWS):
            leaves = forest.value.leaves(matrix(batch.column(1), width, np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([own.tobytes() for own in leaves], pa.binary())],
                                             names=["vec_id", "v", "leaves"])
    return index


class _Nearest:
    """The nearest rows met so far for one query."""

    def __init__(self, k: int):
        self.k, self.ids, self.far = k, np.zeros(0, np.int64), np.zeros(0)

    def add(self, ids: np.ndarray, distances: np.ndarray) -> None:
        if len(self.ids) == self.k:
            near = distances <= self.far[-1]
            ids, distances = ids[near], distances[near]
        if len(ids):
            ids, distances = np.concatenate([self.ids, ids]), np.concatenate([self.far, distances])
            best = np.lexsort((ids, distances))[:self.k]
            self.ids, self.far = ids[best], distances[best]


def _rank(queries, width: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, points, opened = queries.value
        # Queries by leaf.
        leaf = np.concatenate([own for own in opened] or [np.zeros(0, np.int32)])
        asker = np.repeat(np.arange(len(names)), [len(own) for own in opened])
        order = np.argsort(leaf, kind="stable")
        leaf, asker = leaf[order], asker[order]
        lists = [_Nearest(k) for _ in names]
        for batch in parts(batches, BLOCK_ROWS):
            ids = batch.column(0).to_numpy()
            x = matrix(batch.column(1), width, np.float64)
            rows = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int32).reshape(len(ids), -1)
            met = np.zeros((len(names), len(ids)), bool)  # a row in several opened leaves counts once
            flat = np.argsort(rows, axis=None, kind="stable")
            held = rows.reshape(-1)[flat]
            row = flat // rows.shape[1]
            edges = np.flatnonzero(np.diff(held, prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                low, high = np.searchsorted(leaf, [held[a], held[a] + 1])
                if high > low:
                    met[np.ix_(asker[low:high], row[a:b])] = True
            met &= np.asarray(names)[:, None] != ids[None, :]
            for q in np.flatnonzero(met.any(axis=1)).tolist():
                own = np.flatnonzero(met[q])
                lists[q].add(ids[own], np.sqrt(((x[own] - points[q]) ** 2).sum(axis=1)))
        for query, found in zip(names, lists):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found.ids), query)), pa.array(found.ids), pa.array(found.far)],
                    names=["query_id", "vec_id", "score"])
    return rank


def nearest_neighbours(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding",
                       query: Column | None = None, k: int = 10, trees: int = TREES, opened: float = OPENED,
                       pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every query row.

    ``query`` says which rows ask, on the column ``vec_id``; unset, those whose id is divisible by
    100. ``score`` is the Euclidean distance in double precision; ties go to the smaller id, and a
    query does not find itself. Where fewer than ``k`` rows lie in the leaves that a query opened,
    all of them are returned; ``opened`` of at least ``trees`` opens all leaves, which is exact.

    Rows without id or vector, and vectors that are empty, zero, or hold a null or non-finite
    component, take no part. Of rows with one id that with the least vector does. A shorter vector
    ends in zeros. Queries are broadcast in passes of about ``pass_bytes``, each of which reads the
    index once. Other columns are ignored.
    """
    query = F.col("vec_id") % 100 == 0 if query is None else query
    kept = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        finite(F.col("v")) & F.exists("v", lambda x: x != 0))
    rows = stored(one_row_an_id(kept, "vec_id"))
    spark, context = rows.sparkSession, rows.sparkSession.sparkContext
    count, width, asking = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if(query)).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not asking:
        return empty
    share = min(1.0, SAMPLE_ROWS / count)
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(13), "vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    fitted = drawn.select("v").limit(SAMPLE_ROWS).toArrow().column(0).combine_chunks()
    forest = context.broadcast(fit_forest(matrix(fitted, width, np.float64), count, trees))
    shipped(rows)
    kind = "vec_id long, v " + rows.schema["v"].dataType.simpleString() + ", leaves binary"
    index = stored(rows.mapInArrow(_index(forest, width), kind))
    asked = stored(rows.where(query).mapInArrow(_open(forest, width, opened), kind))
    # Passes by a hash of the id, of about equal bytes.
    size = asked.agg(F.sum(F.length("leaves") + 8 * width + 16)).first()[0]
    passes = -(-size // pass_bytes)
    found = None
    for number in range(passes):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).toArrow()
        if not own.num_rows:
            continue
        points = matrix(own.column(1).combine_chunks(), width, np.float64)
        leaves = [np.frombuffer(x.as_py(), np.int32) for x in own.column(2)]
        block = context.broadcast((own.column(0).to_numpy(), points, leaves))
        part = index.mapInArrow(_rank(block, width, k), "query_id long, vec_id long, score double")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
