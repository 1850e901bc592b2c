"""Centroid clustering of integer vectors: Lloyd's rounds with bounds that look back over the history of the centroids.

A vector keeps, for each centroid, its distance when that was last evaluated and the round of it. While a centroid moves on, the
bound is loosened by the norm of its total displacement since that round (the norm of the sum), not by the sum of what it moved
in each round, so a centroid that comes back tightens its bounds again. Only where bounds leave a choice open are distances
evaluated, exactly, in integers; so the classes are those of plain rounds, ties included.

A round is one pass over a written table: vectors, bounds and classes stay in one row, no row meets another, and what reaches
the driver is a row a centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import dropped, written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Integers beyond this have squared distances, or sums over very many rows, that a long can't hold.
MOST = 2**26
#: Added to what bounds, as floats, may be wrong by.
SLACK = 1e-9
_STATE = "vec_id long, q array<int>, cluster int, distance long, known binary"


def kept_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): vectors of exactly that many components, none null or not finite, as integers floor(scale * x)."""
    v = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.coalesce((F.size("v") == dimensions) & F.forall("v", finite), F.lit(False)))
    held = F.when(F.forall("v", lambda x: F.abs(x * scale) <= MOST), F.transform("v", lambda x: F.floor(x * scale).cast("int")))
    return rows.select("vec_id", F.coalesce(held, F.raise_error(F.concat(F.lit(f"components beyond {MOST / scale} in vector "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))).alias("q"))


def assigned(q: np.ndarray, best: np.ndarray, known: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Classes, what is known now, and the number of distances that were evaluated.

    q: integers (n, d). best: the classes so far. known: (n, k, 2), the exact squared distance to each centroid when it was last
    evaluated, and the round of that. history: the centroids of each round so far (rounds, k, d); in the first round everything
    is evaluated.
    """
    now, t, (n, k) = history[-1], len(history) - 1, (len(q), history.shape[1])
    if not t:
        d2 = np.stack([((q - c) ** 2).sum(1) for c in now], 1)
        return d2.argmin(1), np.stack([d2, np.zeros_like(d2)], 2), n * k
    known, best, rows, evaluated = known.copy(), best.copy(), np.arange(n), 0
    moved = np.sqrt(((history - now) ** 2).sum(2).astype(float))  # of each centroid in all, since each round
    was, since = np.sqrt(known[:, :, 0].astype(float)), moved[known[:, :, 1], np.arange(k)]
    margin = SLACK * (1 + was + since)
    lower, upper = was - since - margin, (was + since + margin)[rows, best]
    lower[rows, best] = np.inf

    def evaluate(some: np.ndarray, j: int) -> None:
        nonlocal evaluated
        known[some, j, 0], known[some, j, 1] = ((q[some] - now[j]) ** 2).sum(1), t
        evaluated += len(some)

    # an open row first has its own class evaluated, which tightens the upper bound; then every centroid that is still within it
    again = np.flatnonzero((lower <= upper[:, None]).any(1))
    own = best[again]
    for j in range(k):
        evaluate(again[own == j], j)
    distance = known[again, own, 0]
    limit = np.sqrt(distance.astype(float)) * (1 + SLACK) + SLACK
    for j in range(k):
        at = np.flatnonzero((own != j) & (lower[again, j] <= limit))
        evaluate(again[at], j)
        d2 = known[again[at], j, 0]
        at = at[(d2 < distance[at]) | ((d2 == distance[at]) & (j < best[again[at]]))]
        best[again[at]], distance[at] = j, known[again[at], j, 0]
    return best, known, evaluated


def _pass(history: np.ndarray, final: bool):
    """A round over batches of _STATE; ``known`` holds int64 pairs (distance, round) of each centroid, nothing before the first round."""
    k = history.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            q = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
            best, known = np.asarray(batch.column(2), np.int64), np.zeros((n, k, 2), np.int64)
            if len(history) > 1:
                known = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.int64).reshape(n, k, 2)
            best, known, _ = assigned(q, best, known, history)
            distance = pa.array(((q - history[-1][best]) ** 2).sum(1)) if final else pa.nulls(n, pa.int64())
            records = pa.array([None if final else r.tobytes() for r in known], pa.binary())
            arrays = [batch.column(0), batch.column(1), pa.array(best, pa.int32()), distance, records]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "q", "cluster", "distance", "known"])

    return work


def clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256.

    Vectors are kept as ``kept_vectors`` says; the centroids are at first those of the k vectors with the least
    sha256(`seed:id`), equal ones ordered by their components, and as many as there are vectors if those are fewer than k. Each
    round assigns every vector to the nearest centroid (ties: the smaller number) and replaces each centroid that has vectors by
    the exact floors of their means; then vectors are assigned once more.

    Null, short, long and not finite vectors are no rows of the result; a null id stays null and counts as an empty one in the
    hash; repeated rows are vectors of their own; an empty table gives none; other columns are ignored. A component
    beyond MOST / scale fails the job with the vector's id, since squares of such can't be longs.
    """
    spark = df.sparkSession
    vectors = kept_vectors(df, id_col, vector_col, dimensions, scale)
    now = written(vectors.select("vec_id", "q", F.lit(0).alias("cluster"), F.lit(None).cast("long").alias("distance"), F.lit(None).cast("binary").alias("known")), "vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = now.select("q", drawn.alias("drawn")).orderBy("drawn", "q").limit(k).collect()  # k rows
    history = [np.array([r["q"] for r in first], np.int64).reshape(len(first), dimensions)]
    for _ in range(rounds if first else 0):
        after = written(now.mapInArrow(_pass(np.stack(history), False), _STATE), "vectors")
        dropped(now)
        now, centroids = after, history[-1].copy()
        sums = [F.sum(F.element_at("q", j + 1).cast("long")).alias(f"s{j}") for j in range(dimensions)]
        for r in now.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # a row a centroid
            centroids[r["cluster"]] = [r[f"s{j}"] // r["n"] for j in range(dimensions)]
        history.append(centroids)
    if first:
        after = written(now.mapInArrow(_pass(np.stack(history), True), _STATE).drop("q", "known"), "vectors")
        dropped(now)
        now = after
    known = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(history[-1].tolist())]
    totals = now.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    named = totals.join(spark.createDataFrame(known, "cluster int, centroid_sha256 string"), "cluster")
    named = named.crossJoin(totals.agg(F.sum("cluster_inertia").alias("inertia")))  # one row
    return now.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
