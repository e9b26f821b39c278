"""Exact integer k-means over embeddings with norm-of-sum (ns) bounds.

A vector with exactly ``DIMS`` components, none null or non-finite, becomes
integers floor(1024 * x); other rows are left out. The ``K`` kept vectors with
the smallest lowercase-hex sha256 of "3:<vec_id>" are the first centroids. Each
of ``ROUNDS`` rounds assigns every vector to the nearest centroid (squared
Euclidean distance, ties to the smaller number) and replaces each non-empty
centroid by the componentwise floor of sum / count; a last pass assigns again.

Vectors stand in rows of up to ``BLOCK`` vectors, each with its state: the
assigned centroid, an upper bound on its distance there, a lower bound for
every centroid, and for each bound the round in which it was an exact
distance. The driver keeps the history of all centroids (rounds x K x DIMS
integers). In a later round a bound is loosened by the norm of the centroid's
total displacement since that round, which is never more than the sum of the
drifts in between. Only where the loosened upper bound does not stay under
every other lower bound is the distance to the assigned centroid taken again,
and then the distances to those centroids whose bounds still fail. Those
distances are exact integers, so results are those of a full search.

Every round is one pass without a shuffle that writes blocks with their new
states and sums to the shared folder (the folder of the round before is
dropped then), and one aggregate over the blocks' sums: K rows for the driver.

Nulls and ties: a null vec_id hashes as "3:"; vectors with one vec_id are rows
of their own, and equal hashes go by components. With fewer than K kept
vectors there are as many centroids; without any there are no rows. Components
beyond +-2**26 integers (|x| > 65,536) count as that bound, so that squared
distances fit a long. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, stage_table
from . import common as C

DIMS, K, ROUNDS = 64, 8, 10
SCALE, LARGEST = 1024.0, 1 << 26
BLOCK = 4096
SEED = "3"
#: Bounds are floats: a bound counts as strict only beyond this relative and absolute slack.
SLACK = 1e-9, 1e-6

_BLOCKS = "ids binary, vectors binary, state binary, totals array<struct<cluster:int,n:long,distance:long,sums:array<long>>>, exact long"


def kept_vectors(embeddings: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id and v (array<long>) of the vectors that count."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    whole = F.transform(x, lambda e: F.greatest(F.lit(-LARGEST).cast("long"), F.least(F.lit(LARGEST).cast("long"), F.floor(
        F.greatest(F.lit(-1e12), F.least(F.lit(1e12), e.cast("double"))) * SCALE).cast("long"))))
    return embeddings.where((F.size(x) == dims) & finite).select("vec_id", whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: str = SEED) -> np.ndarray:
    """(k, dims): a distributed top k by hash; k rows reach the driver."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(by, "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _blocks(vectors: DataFrame, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                x = pc.list_flatten(part.column("v")).to_numpy(zero_copy_only=False).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([C.id_column(part, "vec_id").tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                    names=["ids", "vectors"])

    return vectors.mapInArrow(run, "ids binary, vectors binary")


# ---------------------------------------------------------------- one block

def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, row by row or to one centroid: exact 64-bit integers."""
    d = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", d, d)


@dataclass
class Bounds:
    """Of n vectors: assigned centroid; the upper bound and the round it was
    exact in; a lower bound and its round for every centroid."""
    at: np.ndarray
    upper: np.ndarray
    upper_round: np.ndarray
    lower: np.ndarray
    lower_round: np.ndarray

    def pack(self) -> bytes:
        return b"".join(np.ascontiguousarray(a).tobytes() for a in (self.at, self.upper, self.upper_round, self.lower, self.lower_round))

    @classmethod
    def unpack(cls, data: bytes, n: int, k: int) -> Bounds:
        out, at = [], 0
        for kind, shape in ((np.int16, (n,)), (np.float64, (n,)), (np.int16, (n,)), (np.float64, (n, k)), (np.int16, (n, k))):
            size = int(np.prod(shape)) * np.dtype(kind).itemsize
            out.append(np.frombuffer(data[at:at + size], kind).reshape(shape).copy())
            at += size
        return cls(*out)


def start(x: np.ndarray, centroids: np.ndarray) -> tuple[Bounds, int]:
    """The first assignment, from all distances."""
    d = np.stack([distances(x, c) for c in centroids], 1)
    at = d.argmin(1)  # the first of equal ones
    root = np.sqrt(d.astype(np.float64))
    n, k = d.shape
    return Bounds(at.astype(np.int16), root[np.arange(n), at], np.zeros(n, np.int16), root, np.zeros((n, k), np.int16)), n * k


def displacements(history: np.ndarray) -> np.ndarray:
    """[round, centroid]: norm of the centroid's way from that round to the last one."""
    way = (history[-1][None] - history).astype(np.float64)
    return np.sqrt((way ** 2).sum(2))


def reassign(x: np.ndarray, b: Bounds, history: np.ndarray) -> int:
    """Assigns to the last centroids of ``history`` by the bounds of ``b``,
    which are updated; returns the number of distances that were taken."""
    now, moved = len(history) - 1, displacements(history)
    centroids, k = history[-1], history.shape[1]
    every = np.arange(k)
    lower = b.lower - moved[b.lower_round, every]
    upper = b.upper + moved[b.upper_round, b.at]
    beyond = lambda low, up: low * (1 - SLACK[0]) - SLACK[1] > up * (1 + SLACK[0])
    own = b.at[:, None] == every
    loose = np.flatnonzero((~beyond(lower, upper[:, None]) & ~own).any(1))
    exact = len(loose)
    if not exact:
        return 0
    best = distances(x[loose], centroids[b.at[loose]])
    b.upper[loose], b.upper_round[loose] = np.sqrt(best.astype(np.float64)), now
    b.lower[loose, b.at[loose]], b.lower_round[loose, b.at[loose]] = b.upper[loose], now
    fails = ~beyond(lower[loose], b.upper[loose][:, None]) & ~own[loose]
    at = b.at[loose].astype(np.int64)
    for j in every:
        rows = np.flatnonzero(fails[:, j])
        if not len(rows):
            continue
        exact += len(rows)
        d = distances(x[loose[rows]], centroids[j])
        b.lower[loose[rows], j], b.lower_round[loose[rows], j] = np.sqrt(d.astype(np.float64)), now
        nearer = (d < best[rows]) | ((d == best[rows]) & (j < at[rows]))
        at[rows[nearer]], best[rows[nearer]] = j, d[nearer]
    changed = at != b.at[loose]
    b.at[loose] = at
    b.upper[loose[changed]], b.upper_round[loose[changed]] = np.sqrt(best[changed].astype(np.float64)), now
    return exact


def _pass(blocks: DataFrame, history: list[np.ndarray], dims: int, final: bool) -> DataFrame:
    past = np.stack(history)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = past.shape[1]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, data = (batch.column(c)[i].as_py() for c in ("ids", "vectors"))
                x = np.frombuffer(data, np.int32).reshape(-1, dims)
                if len(past) == 1:
                    b, exact = start(x, past[0])
                else:
                    b = Bounds.unpack(batch.column("state")[i].as_py(), len(x), k)
                    exact = reassign(x, b, past)
                totals = []
                d = distances(x, past[-1][b.at]) if final else None
                for j in np.unique(b.at).tolist():
                    mine = b.at == j
                    totals.append({"cluster": j, "n": int(mine.sum()), "distance": int(d[mine].sum()) if final else 0,
                                   "sums": x[mine].sum(0, dtype=np.int64).tolist()})
                state = np.concatenate([b.at.astype(np.int64), d]).tobytes() if final else b.pack()
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids], pa.binary()), pa.array([None if final else data], pa.binary()), pa.array([state], pa.binary()),
                    pa.array([totals], _TOTALS), pa.array([exact], pa.int64())],
                    names=["ids", "vectors", "state", "totals", "exact"])

    return blocks.mapInArrow(run, _BLOCKS)


_TOTALS = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("distance", pa.int64()), ("sums", pa.list_(pa.int64()))]))


def _totals(blocks: DataFrame, dims: int) -> list:
    """Count, distance and component sums by cluster: at most k rows."""
    t = blocks.select(F.inline("totals"))
    return t.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("distance").alias("distance"),
                                    *(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(dims))).collect()


@dataclass
class Clusters:
    """history[r]: centroids after r rounds; assigned: blocks of the final
    assignment; exact: distances taken in each assignment (the last one's too)."""
    history: list[np.ndarray]
    assigned: DataFrame | None
    inertia: dict[int, int] = field(default_factory=dict)
    exact: list[int] = field(default_factory=list)


def cluster(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, seed: str = SEED) -> Clusters:
    spark = embeddings.sparkSession
    C.prepare(spark)
    vectors = kept_vectors(embeddings, dims)
    first = first_centroids(vectors, k, seed)
    out = Clusters([first], None)
    if not len(first):
        return out
    blocks, path = _blocks(vectors, dims), None
    for r in range(rounds + 1):
        final = r == rounds
        before = path
        blocks, path = stage_table(_pass(blocks, out.history, dims, final), "clusters")
        if before:
            drop_path(spark, before)
        sums = _totals(blocks, dims)
        out.exact.append(blocks.agg(F.sum("exact")).first()[0])
        if final:
            out.assigned, out.inertia = blocks, {t["cluster"]: t["distance"] for t in sums}
        else:
            following = out.history[-1].copy()
            for t in sums:
                following[t["cluster"]] = [t[f"s{i}"] // t["n"] for i in range(dims)]
            out.history.append(following)
    return out


_ASSIGNED = "vec_id long, cluster int, distance long"


def assignments(found: Clusters) -> DataFrame:
    """vec_id, cluster, distance of every kept vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                at, d = np.frombuffer(batch.column("state")[i].as_py(), np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([C.id_array(ids), pa.array(at.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])

    return found.assigned.mapInArrow(run, _ASSIGNED)


def report(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, seed: str = SEED) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256."""
    found = cluster(embeddings, k, rounds, dims, seed)
    if found.assigned is None:
        return embeddings.sparkSession.createDataFrame([], f"{_ASSIGNED}, cluster_inertia long, inertia long, centroid_sha256 string")
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.history[-1]]
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return assignments(found).select("*", pick([found.inertia.get(j, 0) for j in range(len(sha))]).cast("long").alias("cluster_inertia"),
                                     F.lit(sum(found.inertia.values())).cast("long").alias("inertia"), pick(sha).alias("centroid_sha256"))


def _oracle(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, seed: str = SEED) -> str:
    parts = [f"""WITH v AS MATERIALIZED (
SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({int(SCALE)} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
FROM (SELECT v, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
SELECT r, min(struct_pack(d := d, c := c)) AS a
FROM (SELECT r, c, CAST(list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM v, c{r}) GROUP BY r)""")
        if r < rounds:
            parts.append(f"""s{r} AS (
SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m
FROM (SELECT a.c AS c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT a.a AS a, unnest(v.v) AS x, unnest(range({dims})) AS i FROM a{r} a JOIN v ON a.r = v.r) GROUP BY a.c, i) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(s{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN s{r} ON c{r}.c = s{r}.c)""")
    n = rounds
    return ",\n".join(parts) + f"""
SELECT v.vec_id, CAST(a.a.c AS INTEGER) AS cluster, a.a.d AS distance, CAST(sum(a.a.d) OVER (PARTITION BY a.a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{n}.m, ',')) AS centroid_sha256
FROM v JOIN a{n} a ON v.r = a.r JOIN c{n} ON c{n}.c = a.a.c
"""


ORACLE = _oracle()
