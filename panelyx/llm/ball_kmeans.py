"""Centroid clustering by balls (operator 12): exact k-means over integer vectors that compares only with near centroids.

A cluster's members are a ball around its centroid. In every task the members of one batch that share a cluster form such
a ball, with the radius of their farthest member. Another centroid is a neighbour only if half its distance from this one
is within the radius. Neighbours are taken nearest first: they cut the ball into a stable core (members nearer than half
the way to the nearest neighbour, which cannot leave) and annuli (a member in the k-th annulus may go to the k nearest
neighbours and to no other), so a member is compared with exactly those. All comparisons are of squared integers,
4 d(x, c)**2 < d(c, c')**2 for "cannot leave", so that ties are seen and go to the smaller number.

The balls are those of the assignment that is written beside the vectors. Results do not depend on it: an old assignment
only makes balls larger. It is written anew when more than ``reform`` of the vectors have left their balls, and once after
the first round; the folder of the one before goes. Rounds read the table and send sums by cluster and component.

Kept are vectors of exactly ``width`` components without null, NaN or infinity. Components become floor(scale * x) in
doubles. Up to 2**20 arithmetic in doubles is exact; larger components go through Python's integers, and the job stops
with an error where a squared distance is no 64-bit integer or a component passes 2**62.

Defined results: an empty table, or one without such vectors, gives an empty result; with fewer than k vectors there are
as many clusters; repeated rows are rows of their own; a null id comes last in the order of seeds; of seeds with one hash the
smaller vector comes first; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, shared_checkpoints

EXACT = 2**20  # squared distances over 64 components stay below 2**53
LARGEST = 2**62


def kept(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 64) -> DataFrame:
    """vec_id and v (array of doubles) of the usable vectors."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.coalesce((F.size(v) == width) & finite, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def integers(x: np.ndarray, scale: int = 1024) -> np.ndarray:
    """floor(scale * x): doubles that hold integers where all is small, Python's integers else."""
    with np.errstate(over="ignore"):
        y = np.floor(x * float(scale))
    if not y.size or np.abs(y).max() <= EXACT:
        return y
    if not np.abs(y).max() <= LARGEST:
        raise ValueError("a component is too large for squared distances of 64 bits")
    return np.array([int(z) for z in y.ravel()], object).reshape(y.shape)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x from c."""
    d = x - c
    return (d * d).sum(axis=1)


def nearest(x: np.ndarray, centroids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of every row, given the balls they were in, and the number of distances computed."""
    k = len(centroids)
    best, distance, compared = before.copy(), np.zeros(len(x), x.dtype), 0
    for i in np.unique(before):
        members = np.flatnonzero(before == i)
        ball = x[members]
        own = squared(ball, centroids[i])
        between = squared(centroids, centroids[i])
        compared += len(members)
        reach = 4 * own
        radius = reach.max()
        # neighbours of the ball, nearest first; what lies farther than twice the radius can take no member
        near = sorted((j for j in range(k) if j != i and between[j] <= radius), key=lambda j: (between[j], j))
        to, least = np.full(len(members), i), own.copy()
        for j in near:
            inside = np.flatnonzero(reach >= between[j])  # the annuli from this neighbour outward
            d = squared(ball[inside], centroids[j])
            compared += len(inside)
            wins = (d < least[inside]) | ((d == least[inside]) & (j < to[inside]))
            to[inside[wins]], least[inside[wins]] = j, d[wins]
        best[members], distance[members] = to, least
    return best, distance, compared


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Balls:
    """Centroids between rounds; small, so that tasks get them with their code."""

    centroids: list[list[int]]
    width: int
    scale: int

    def assigned(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        x = integers(_matrix(batch.column("v"), self.width), self.scale)
        c = np.array(self.centroids, object)
        if x.dtype != object and max((abs(y) for row in self.centroids for y in row), default=0) <= EXACT:
            c = c.astype(float)
        else:
            x = np.array([int(z) for z in x.ravel()], object).reshape(x.shape)
        before = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
        return (x, *nearest(x, c, before))

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each cluster and component: sum, and for component 0 also rows, rows that moved, summed distance."""
        k = len(self.centroids)
        total = [[0] * self.width for _ in range(k)]
        rows, moved, spread = [0] * k, [0] * k, [0] * k
        for batch in batches:
            if not batch.num_rows:
                continue
            x, to, distance, _ = self.assigned(batch)
            left = to != batch.column("cluster").to_numpy(zero_copy_only=False)
            for i in np.unique(to):
                of = to == i
                total[i] = [a + int(b) for a, b in zip(total[i], x[of].sum(axis=0), strict=True)]
                rows[i] += int(of.sum())
                moved[i] += int((of & left).sum())
                spread[i] += int(distance[of].sum())
        there = [(i, j, str(total[i][j]), rows[i] if j == 0 else 0, moved[i] if j == 0 else 0, str(spread[i] if j == 0 else 0)) for i in range(k) if rows[i] for j in range(self.width)]
        columns = list(zip(*there, strict=True)) if there else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["cluster", "component", "s", "rows", "moved", "spread"])

    def moved(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The table with its assignment brought up to these centroids."""
        for batch in batches:
            if batch.num_rows:
                to = self.assigned(batch)[1]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(to, pa.int32())], ["vec_id", "v", "cluster"])

    def verdicts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, to, distance, _ = self.assigned(batch)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(to, pa.int32()), pa.array([int(d) for d in distance], pa.int64())], ["vec_id", "cluster", "distance"])


class _Table:
    """Vectors with their balls, a written table in the shared folder; a new one replaces the old."""

    def __init__(self, rows: DataFrame) -> None:
        self.spark = rows.sparkSession
        shared_checkpoints(self.spark)
        self.path = ""
        self.write(rows)

    def write(self, rows: DataFrame) -> None:
        path = f"{self.spark.sparkContext.getCheckpointDir()}/balls-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        if self.path:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.path = path

    def read(self) -> DataFrame:
        return self.spark.read.schema("vec_id long, v array<double>, cluster int").parquet(self.path)


def _round(table: _Table, balls: Balls) -> tuple[dict[int, tuple[list[int], int, int]], int]:
    """By cluster: sums of components, rows, summed distance; and how many rows lie outside the ball they are written with."""
    part = table.read().mapInArrow(balls.sums, "cluster int, component int, s string, rows long, moved long, spread string")
    whole = part.groupBy("cluster", "component").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("rows").alias("rows"), F.sum("moved").alias("moved"), F.sum(F.col("spread").cast("decimal(38,0)")).alias("spread"))
    found: dict[int, list] = {}
    left = 0
    for r in whole.collect():  # k * width rows
        one = found.setdefault(r["cluster"], [[0] * balls.width, 0, 0])
        one[0][r["component"]] = int(r["s"])
        one[1] += r["rows"]
        one[2] += int(r["spread"])
        left += r["moved"]
    return {i: tuple(x) for i, x in found.items()}, left


def cluster(vectors: DataFrame, *, k: int = 8, rounds: int = 10, seed: int = 3, width: int = 64, scale: int = 1024, reform: float = 0.1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector after the given rounds."""
    usable = kept(vectors, id_col=id_col, vector_col=vector_col, width=width)
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = usable.orderBy(by_hash.asc_nulls_last(), "vec_id", "v").limit(k).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not seeds:
        return vectors.sparkSession.createDataFrame([], schema)
    start = integers(np.array([r["v"] for r in seeds], float), scale)
    balls = Balls([[int(y) for y in row] for row in start], width, scale)
    table = _Table(usable.withColumn("cluster", F.lit(0)))
    for number in range(rounds):
        found, left = _round(table, balls)
        rows = sum(n for _, n, _ in found.values())
        if number == 0 or left > reform * rows:
            table.write(table.read().mapInArrow(balls.moved, "vec_id long, v array<double>, cluster int"))
        balls = Balls([[s // found[i][1] for s in found[i][0]] if i in found else c for i, c in enumerate(balls.centroids)], width, scale)
    found, _ = _round(table, balls)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in balls.centroids]
    spread = [found[i][2] if i in found else 0 for i in range(len(digest))]
    at = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), F.col("cluster") + 1)
    out = table.read().mapInArrow(balls.verdicts, "vec_id long, cluster int, distance long")
    return out.select("vec_id", "cluster", "distance", at(spread).cast("long").alias("cluster_inertia"), F.lit(sum(spread)).cast("long").alias("inertia"), at(digest).alias("centroid_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))


def oracle_sql(k: int = 8, rounds: int = 10, seed: int = 3, width: int = 64) -> str:
    """Plain k-means, every vector against every centroid."""
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {width})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS k, v AS c FROM v ORDER BY sha256('{seed}:' || vec_id), v LIMIT {k})",
    ]
    for t in range(rounds + 1):
        steps.append(f"d{t} AS (SELECT rid, k, list_sum(list_transform(range(1, {width + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS d FROM v, c{t})")
        steps.append(f"a{t} AS MATERIALIZED (SELECT rid, arg_min(k, (d, k)) AS k, CAST(min(d) AS BIGINT) AS d FROM d{t} GROUP BY rid)")
        if t < rounds:
            steps.append(f"s{t} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range(1, {width + 1})) AS i FROM a{t} JOIN v USING (rid)) GROUP BY k, i)")
            steps.append(f"m{t} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{t} GROUP BY k)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT c{t}.k AS k, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (k))")
    last = f"SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} USING (k)"
    return f"WITH {', '.join(steps)} {last}"
