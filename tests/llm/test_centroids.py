import hashlib
import math

import duckdb
import numpy as np
import pytest

from tracewright.llm import centroids
from tracewright.llm.queries import ORACLES, op11_centroid_clustering


def plain(rows, k, rounds, seed=3, scale=1024):
    """(vec_id, cluster, distance) by rounds that evaluate every distance, and the final centroids."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(now))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        now = [[sum(col) // len(col) for col in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(now)]
    return [(i, *reversed(nearest(v))) for i, v in kept], now


def test_bounds_settle_most_distances_and_never_wrongly():
    draw = np.random.default_rng(4)
    q = np.concatenate([draw.normal(m, 30, (300, 6)) for m in (0, 400, 900)]).astype(np.int64)
    now = q[draw.choice(len(q), 7, replace=False)]
    history, best, known, total = [now], np.zeros(len(q), np.int64), None, 0
    for t in range(25):
        best, known, n = centroids.assigned(q, best, known, np.stack(history))
        d2 = ((q[:, None] - history[-1][None]) ** 2).sum(2)
        assert (best == d2.argmin(1)).all()
        total += n * (t > 0)
        # centroids that come back at times: a bound over all displacements is then tighter than one over the sum of rounds
        step = np.stack([q[best == j].sum(0) // max(1, (best == j).sum()) if (best == j).any() else history[-1][j] for j in range(7)])
        history.append(history[-3] if t % 4 == 3 else step)
    assert total < 0.5 * 24 * q.shape[0] * 7


def test_ties_go_to_the_smaller_number():
    q = np.array([[0, 0], [2, 0], [1, 5]], np.int64)
    history = [np.array([[0, 0], [2, 0]], np.int64), np.array([[2, 0], [0, 0]], np.int64), np.array([[1, 0], [1, 0]], np.int64)]
    best, known, _ = centroids.assigned(q, None, None, np.stack(history[:1]))
    assert best.tolist() == [0, 1, 0]
    best, known, _ = centroids.assigned(q, best, known, np.stack(history[:2]))
    assert best.tolist() == [1, 0, 0]
    best, known, _ = centroids.assigned(q, best, known, np.stack(history))
    assert best.tolist() == [0, 0, 0]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_clusters_of_odd_rows(spark, k):
    draw = np.random.default_rng(k)
    good = [(i, [float(x) for x in draw.normal(0, 1, 4)]) for i in range(30)] + [(7, [0.5, -0.5, 0.0, 1e-9])] * 2 + [(None, [0.1, 0.2, 0.3, 0.4])] * 2
    odd = [(100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, 2.0, 3.0, 4.0, 5.0]), (104, [1.0, None, 3.0, 4.0]), (105, [1.0, float("nan"), 3.0, 4.0]), (106, [1.0, float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in good + odd], "vec_id long, embedding array<double>, cluster string, q int")
    got = centroids.clusters(df, k=k, rounds=4, dimensions=4).collect()
    want, final = plain(good, k, 4)
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, final[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster) and r.inertia == sum(w[2] for w in want)


def test_empty_table_and_too_large_components(spark):
    schema = "vec_id long, embedding array<float>"
    out = centroids.clusters(spark.createDataFrame([], schema))
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="in vector 5"):
        centroids.clusters(spark.createDataFrame([(5, [1e30, 0.0])], schema), dimensions=2).collect()


def test_query_against_sql(spark, tiny):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tiny}/embeddings.parquet'")
    got = op11_centroid_clustering(spark, tiny)
    want = con.execute(ORACLES["op11_centroid_clustering"]).fetchall()
    assert len(want) and sorted(map(tuple, got.collect())) == sorted(want)
