"""Hard negatives and nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardweave.llm import hard_negatives, projection_forest
from cardweave.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def rows_of(df):
    return [(r.vec_id, r.embedding, r.label) for r in df.collect()]


def usable(rows):
    """By id the least (label, vector) of the rows that take part in hard negatives."""
    out = {}
    for vec_id, vector, label in rows:
        if None not in (vec_id, vector, label) and all(x is not None and math.isfinite(x) for x in vector):
            own = (label, [max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * float(x)))) for x in vector])
            out[vec_id] = min(out.get(vec_id, own), own)
    return out


def slow_negatives(rows, every=100):
    rows = usable(rows)
    dot = lambda a, b: max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b))))
    out = set()
    for anchor, (label, vector) in rows.items():
        if anchor % every:
            continue
        scored = sorted((-dot(vector, v), i, own) for i, (own, v) in rows.items() if i != anchor)
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            window = [(-s, i) for s, i, own in scored if own != label and 80 * -score <= 100 * -s <= 100 * -score][:5]
            out |= {(anchor, positive, k, i, -score, s) for k, (s, i) in enumerate(window, 1)}
    return out


def got_negatives(df):
    rows = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_hard_negatives_of_the_given_table(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    want = slow_negatives(rows_of(spark.read.parquet(f"{folder}/embeddings.parquet").withColumn("label", label)))
    got = QUERIES["op11_hard_negatives"](spark, folder)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    assert got_negatives(got) == want and want


ODD = [(0, [1.0, 0.5, 0.25], 1), (0, [1.0, 0.5, 0.25], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, [1.0, 0.5], 2),
       (4, [1.0, 0.5], 2), (5, None, 1), (6, [None, 1.0], 1), (7, [NAN, 1.0], 2), (8, [INF, 1.0], 2), (9, [1.0], None),
       (None, [1.0], 1), (10, [], 1), (11, [0.0, 0.0], 2), (20, [-1.0, -1.0], 1), (21, [-1.0, -1.0], 2), (30, [0.9, 0.4], 3),
       (40, [1.0, 0.5, 0.25], 1), (50, [3e9, 1.0], 4), (51, [2e9, 1.0], 4), (52, [1.9e9, 1.0], 5)]


def odd(spark, rows=ODD):
    clashing = ", ".join(f"{c} int" for c in ("tree", "spot", "rank", "v", "leaves", "score"))
    return spark.createDataFrame([(*r, *[1] * 6) for r in rows], f"vec_id long, embedding array<double>, label int, {clashing}")


@pytest.mark.parametrize("tree,bytes_", [(512, 1 << 24), (2, 1)])
def test_hard_negatives_of_odd_rows(spark, tree, bytes_):
    got = hard_negatives.mine_hard_negatives(odd(spark).repartition(3), anchor=F.col("vec_id") % 10 == 0,
                                             tree_anchors=tree, pass_bytes=bytes_)
    assert got_negatives(got) == slow_negatives(ODD, 10)


def test_no_vectors(spark):
    for rows in (odd(spark).limit(0), odd(spark).where("vec_id = 1"), odd(spark).where("vec_id IN (5, 6)")):
        assert hard_negatives.mine_hard_negatives(rows).count() == 0
        assert projection_forest.nearest_neighbours(rows).count() == 0


def test_bounds_spare_scores():
    """Clustered vectors: most candidates of a child are told from the parent's scores."""
    class Value:
        pass
    import pyarrow as pa
    random = np.random.default_rng(0)
    centres = random.normal(size=(10, 16)) * 1000
    points = np.floor(centres[np.arange(4000) % 10] + random.normal(size=(4000, 16)) * 5).astype(np.int64)
    anchors = points[:200]
    order, parent, edge = hard_negatives.spanning_tree(anchors.astype(float))
    assert parent[0] == -1 and (parent[1:] < np.arange(1, 200)).all()
    lengths = np.linalg.norm(anchors[order[1:]] - anchors[order[parent[1:]]], axis=1)
    assert np.allclose(lengths, edge[1:])
    trees, count = Value(), {}
    trees.value = hard_negatives.Trees(order, order % 10, anchors[order], parent, edge, [0, 200], [[]] * 200)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(4000)), pa.array(np.arange(4000) % 10), pa.array(list(points))],
                                       names=["vec_id", "label", "v"])
    list(hard_negatives._search(trees, 16, 5, hard_negatives._Positives, count)(iter([batch])))
    assert count["scored"] < 0.3 * count["bounded"]


def slow_neighbours(rows, every, k=10):
    own = {}
    for vec_id, vector, _ in rows:
        if vec_id is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector):
            own[vec_id] = min(own.get(vec_id, vector), vector)
    width = max(map(len, own.values()), default=0)
    ids = np.array(sorted(own))
    x = np.array([[*own[i], *[0.0] * (width - len(own[i]))] for i in ids])
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        far = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        best = [n for n in np.lexsort((ids, far)) if n != at][:k]
        out[int(ids[at])] = [(int(ids[n]), float(far[n])) for n in best]
    return out


def got_neighbours(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r["rank"] == len(own)
    return out


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_neighbours_reach_a_recall_of_nine_tenths(spark, size):
    folder = f"/root/testdata/{size}"
    rows = rows_of(spark.read.parquet(f"{folder}/embeddings.parquet"))
    want, got = slow_neighbours(rows, 100), got_neighbours(QUERIES["op13_projection_forest"](spark, folder))
    hits = sum(len({i for i, _ in own} & {i for i, _ in got[q]}) for q, own in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    vectors = {i: np.array(v, float) for i, v, _ in rows}
    for q, own in got.items():
        assert len(own) == 10 and own == sorted(own, key=lambda r: (r[1], r[0]))
        assert all(math.isclose(s, np.linalg.norm(vectors[q] - vectors[i]), rel_tol=1e-12) for i, s in own)


@pytest.mark.parametrize("bytes_", [1 << 24, 1])
def test_all_leaves_opened_is_exact(spark, bytes_):
    random = np.random.default_rng(5)
    rows = ODD + [(100 + i, random.normal(size=3).round(1).tolist(), 0) for i in range(600)] + \
        [(900 + i, [0.5, 0.5, 0.5], 0) for i in range(400)]  # ties, and a vector that a third of the rows share
    got = projection_forest.nearest_neighbours(odd(spark, rows).repartition(3), opened=99.0, pass_bytes=bytes_ * 4000)
    assert got_neighbours(got) == slow_neighbours(rows, 100)
