"""Centroid clustering in integers: k-means rounds that skip centroids by a bound in rotated coordinates.

Every vector is stored once with its integers, its leading coordinates in a
PCA rotation and the norm of what the rotation leaves over. For a vector v and
a centroid c, with leading coordinates y and left-over norms r,

    |v - c|^2 >= |y(v) - y(c)|^2 + (r(v) - r(c))^2,

so a centroid whose bound is above the best exact distance so far is passed
by. Survivors are measured in 64-bit integers; the bound is lowered by far
more than its rounding, so the result is the plain one, whatever the rotation.
Centroids in a round: sums and counts by task, added up as decimals, divided
by floor in exact integers. The driver holds k centroids and k sums.

Defined cases: a vector is kept if it has exactly ``dim`` components, none
null or non-finite; others have no row. Equal distances go to the smaller
number. A null id gets a cluster but starts none; equal ids start in order of
their components; rows repeat as they come. Fewer kept vectors than ``k``
make fewer centroids, an empty table an empty result. Components beyond
``LIMIT`` in size raise, as their squared distances would not fit in 64 bits.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import saved, table

DIM, K, ROUNDS, SCALE = 64, 8, 10, 1024
#: Largest integer component: 64 squares of differences of two stay below 2 ** 62.
LIMIT = 1 << 27
#: Leading coordinates that are stored.
LEADING = 12
#: Rows that one numpy step measures at a time.
STEP = 16_384

STORED = "vec_id long, ints binary, lead binary, rest double"


def start_order(vec_id: Column) -> Column:
    """Hash by which the first centroids are chosen."""
    return F.sha2(F.concat(F.lit("3:"), vec_id.cast("string")), 256)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM,
                    scale: int = SCALE) -> DataFrame:
    """(vec_id, comp array<long>) of the kept vectors: floor(scale * x) of every component."""
    x = F.col("x")
    fit = (F.size("x") == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")) \
        .filter(F.col("x").isNotNull() & fit)
    whole = F.transform(x, lambda v: F.when(F.abs(v) <= LIMIT / scale, F.floor(v * scale))
                        .otherwise(F.raise_error(F.lit(f"a component is beyond {LIMIT // scale}")).cast("long")))
    return kept.select("vec_id", whole.alias("comp"))


def rotation(ints: DataFrame, dim: int, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and the leading principal axes (dim x lead), from sums that the tasks make of all vectors."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            x = batch.column("comp").flatten().to_numpy().reshape(-1, dim).astype(np.float64)
            n, total, square = n + len(x), total + x.sum(0), square + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim + 1), pa.int32()),
                 pa.array([*square.tolist(), [*total.tolist()]], pa.list_(pa.float64())),
                 pa.array([n] * (dim + 1), pa.int64())], names=["i", "sums", "n"])
    parts = ints.select("comp").mapInArrow(partial, "i int, sums array<double>, n long")
    got = parts.select("i", F.posexplode("sums").alias("j", "s"), "n").groupBy("i", "j") \
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()            # dim x (dim + 1) numbers
    m, n = np.zeros((dim + 1, dim)), 1
    for r in got:
        m[r.i, r.j], n = r.s, r.n
    mean = m[dim] / n
    _, axes = np.linalg.eigh(m[:dim] / n - np.outer(mean, mean))
    return mean, np.ascontiguousarray(axes[:, ::-1][:, :lead])


def _rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of the rest."""
    moved = x - mean
    lead = moved @ axes
    return lead, np.sqrt(np.maximum((moved * moved).sum(1) - (lead * lead).sum(1), 0.0))


def _store(mean: np.ndarray, axes: np.ndarray, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("comp").flatten().to_numpy().reshape(-1, dim)
            lead, rest = _rotated(x.astype(np.float64), mean, axes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()),
                 pa.array([r.tobytes() for r in lead.astype("<f8")], pa.binary()), pa.array(rest)],
                names=["vec_id", "ints", "lead", "rest"])
    return run


@dataclass
class Rotated:
    """Stored vectors and the rotation they are stored in."""
    rows: DataFrame
    mean: np.ndarray
    axes: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.mean)


def store(ints: DataFrame, dim: int = DIM, lead: int = LEADING) -> Rotated:
    """Write the vectors with their rotated coordinates to the shared folder."""
    mean, axes = rotation(ints, dim, lead)
    return Rotated(saved(ints.mapInArrow(_store(mean, axes, dim), STORED), "centroid-vectors"), mean, axes)


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, clead: np.ndarray,
            crest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of every vector's nearest centroid, and how many distances were measured."""
    bound = ((rest[:, None] - crest) ** 2)
    for c in range(len(centroids)):
        d = lead - clead[c]
        bound[:, c] += np.einsum("ij,ij->i", d, d)
    # Rounding of the rotation is some 1e-15 of these sizes; the slack is a million times that.
    scale = (lead * lead).sum(1) + rest * rest
    bound -= 1e-9 * (scale[:, None] + (clead * clead).sum(1) + crest * crest + 1.0)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(x), np.iinfo(np.int64).max)
    who = np.zeros(len(x), np.int64)
    live, measured = np.arange(len(x)), 0
    for place in range(len(centroids)):
        c = order[live, place]
        live = live[bound[live, c] <= best[live]]        # bounds come in ascending order: the others are done
        if not len(live):
            break
        c = order[live, place]
        d = x[live] - centroids[c]
        dist = np.einsum("ij,ij->i", d, d)
        measured += len(live)
        better = (dist < best[live]) | ((dist == best[live]) & (c < who[live]))
        best[live[better]], who[live[better]] = dist[better], c[better]
    return who, best, measured


def _assigned(centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray):
    """Steps of (batch slice, integers, cluster, distance, distances measured)."""
    clead, crest = _rotated(centroids.astype(np.float64), mean, axes)
    dim, m = axes.shape

    def steps(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                x = np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)
                lead = np.frombuffer(b"".join(batch.column("lead").to_pylist()), "<f8").reshape(-1, m)
                rest = batch.column("rest").to_numpy()
                yield batch, x, *nearest(x, lead, rest, centroids, clead, crest)
    return steps


def _sums(centroids, mean, axes):
    steps, k, dim = _assigned(centroids, mean, axes), len(centroids), axes.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, measured = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), 0
        for _, x, who, _, n in steps(batches):
            count += np.bincount(who, minlength=k)
            for c in np.unique(who):
                total[c] += x[who == c].sum(0)
            measured += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k), pa.int32()), pa.array(count), pa.array(total.tolist(), pa.list_(pa.int64())),
             pa.array([measured] + [0] * (k - 1), pa.int64())], names=["cluster", "n", "sums", "measured"])
    return run


def _labels(centroids, mean, axes):
    steps = _assigned(centroids, mean, axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, who, dist, _ in steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(dist)],
                                             names=["vec_id", "cluster", "distance"])
    return run


def refine(stored: Rotated, centroids: np.ndarray, rounds: int = ROUNDS, log: list | None = None) -> np.ndarray:
    """The centroids after ``rounds`` rounds; ``log`` gets per round the distances measured and the rows."""
    exact = T.DecimalType(38, 0)
    for _ in range(rounds):
        parts = stored.rows.mapInArrow(_sums(centroids, stored.mean, stored.axes),
                                       "cluster int, n long, sums array<long>, measured long")
        got = parts.select("cluster", "n", "measured", F.posexplode("sums").alias("j", "s")).groupBy("cluster", "j") \
            .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(exact)).alias("s"),
                 F.sum("measured").alias("measured")).collect()                # k x dim numbers
        new = centroids.copy()
        for r in got:
            if r.n:
                new[r.cluster, r.j] = int(r.s) // r.n
        if log is not None:
            first = [r for r in got if r.j == 0]
            log.append((sum(r.measured for r in first), sum(r.n for r in first)))
        centroids = new
    return centroids


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM,
                      k: int = K, rounds: int = ROUNDS, scale: int = SCALE, lead: int = LEADING,
                      log: list | None = None) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    ints = integer_vectors(vectors, id_col, vector_col, dim, scale)
    first = ints.filter("vec_id IS NOT NULL").orderBy(start_order(F.col("vec_id")), "vec_id", "comp").limit(k).collect()
    if not first:       # nothing to start from
        return spark.createDataFrame([], schema)
    stored = store(ints, dim, min(lead, dim))
    centroids = refine(stored, np.array([r.comp for r in first], np.int64), rounds, log)
    labels = saved(stored.rows.mapInArrow(_labels(centroids, stored.mean, stored.axes),
                                          "vec_id long, cluster int, distance long"), "centroid-labels")
    sums = {r.cluster: int(r.s) for r in labels.groupBy("cluster").agg(
        F.sum(F.col("distance").cast(T.DecimalType(38, 0))).alias("s")).collect()}            # at most k rows
    total = sum(sums.values())
    facts = [(c, sums.get(c, 0), total, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
             for c, row in enumerate(centroids.tolist())]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return labels.join(F.broadcast(facts), "cluster").select(*[c.split(" ")[0] for c in schema.split(", ")])  # k rows


def op13_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _op13_sql(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> str:
    """Plain rounds without bounds: every distance of every vector."""
    def assigned(r):
        return f"""a{r} AS MATERIALIZED (SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.rid, m.c, CAST(list_sum(list_transform(range(1, {dim + 1}), lambda i: (v.comp[i] - m.comp[i]) * (v.comp[i] - m.comp[i]))) AS BIGINT) AS d
    FROM kept v, m{r} m) GROUP BY rid)"""

    def moved(r):
        return f"""m{r + 1} AS MATERIALIZED (SELECT m.c, coalesce(n.comp, m.comp) AS comp FROM m{r} m LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS comp FROM (
        SELECT c, i, sum(comp[i]) AS s, count(*) AS n FROM a{r} JOIN kept USING (rid), range(1, {dim + 1}) t(i) GROUP BY c, i)
    GROUP BY c) n USING (c))"""
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS comp FROM embeddings
    WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
             f"""m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vec_id, comp) - 1 AS c, comp FROM (
    SELECT sha256('3:' || vec_id) AS h, vec_id, comp FROM kept WHERE vec_id IS NOT NULL ORDER BY h, vec_id, comp LIMIT {k}))"""]
    for r in range(rounds):
        parts += [assigned(r), moved(r)]
    parts.append(assigned(rounds))
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.comp, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (rid) JOIN m{rounds} m ON a.c = m.c"""


OP13_SQL = _op13_sql()
