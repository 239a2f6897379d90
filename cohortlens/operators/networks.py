"""Feed-forward networks of many models, trained together: one pass over the rows gives each its loss and gradient.

Topology, loss, blocks, L-BFGS and line search are those of Spark's multilayer
perceptron, so a network ends where Spark's own fit ends but for rounding. What
differs is the cost: Spark reads, scales and packs the rows anew for every fit
(a round of a few steps) and runs a job a network and step. Here the inputs of
all networks are packed once, a row of doubles each, and written; a job then
evaluates every network that still trains, each at its own weights, on the
columns it uses. Tasks add losses and gradients up by network, so what leaves
them, like what goes to them, has the size of the weights.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .boosting import _bytes, binary_rows, task_count

#: Rows that a network looks at together, and bytes of sums that go to the driver without being added up by tasks.
CHUNK, SUMS_BYTES = 1024, 32 << 20
#: Past steps that L-BFGS keeps, past losses that its stop rule looks at, trials of a line search and of its zoom.
MEMORY, LOSSES, TRIALS = 10, 20, 10
#: Least probability in the validation loss.
LEAST = 1e-7


@dataclass
class NetworkJob:
    """A network to train: its columns of the packed rows, its layer sizes and weights, and when it stops."""
    columns: list
    layers: list
    weights: np.ndarray
    max_iter: int
    patience: int
    step: int
    tol: float = 1e-6


# --- packed rows -------------------------------------------------------------------

def packed(rows: DataFrame, values, shift, scale, block: int) -> DataFrame:
    """(label, weight, x) of training and validation rows: ``values`` (an array column) less ``shift`` times ``scale``.

    A training row weighs 1 / the rows of its block, as blocks of ``block`` rows count alike however full
    they are; validation rows weigh 0."""
    width, shift, scale = len(shift), np.asarray(shift), np.asarray(scale)

    def batch_of(label, weight, x):
        return pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(weight, pa.float64()), binary_rows(x)],
                                          names=["label", "weight", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros(0, np.int32), np.zeros((0, width))          # training rows short of a block
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("__values").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            x = (x - shift) * scale
            label, train = batch.column("label").to_numpy(zero_copy_only=False), batch.column("__train").to_numpy(zero_copy_only=False)
            if not np.isfinite(x[train]).all():
                raise ValueError("a network's inputs must be finite numbers")
            yield batch_of(label[~train], np.zeros((~train).sum()), x[~train])
            label, x = np.concatenate([rest[0], label[train]]), np.concatenate([rest[1], x[train]])
            whole = len(x) // block * block
            yield batch_of(label[:whole], np.full(whole, 1.0 / block), x[:whole])
            rest = label[whole:], x[whole:]
        if len(rest[0]):
            yield batch_of(rest[0], np.full(len(rest[0]), 1.0 / len(rest[0])), rest[1])

    return rows.filter(F.col("split").isin("train", "validation")) \
        .select(F.col("label").cast("int").alias("label"), (F.col("split") == "train").alias("__train"), values.alias("__values")) \
        .mapInArrow(run, "label int, weight double, x binary")


# --- one network on some rows ---------------------------------------------------------

def _layers(weights: np.ndarray, layers: list) -> list:
    """(matrix, bias) of every layer, in the order Spark keeps them."""
    out, at = [], 0
    for n, m in zip(layers, layers[1:]):
        out.append((weights[at:at + n * m].reshape(n, m), weights[at + n * m:at + n * m + m]))
        at += n * m + m
    return out


def _outputs(x: np.ndarray, parts: list) -> list:
    """The outputs of every layer: sigmoids, and softmax on top."""
    out = [x]
    for i, (matrix, bias) in enumerate(parts):
        z = out[-1] @ matrix
        z += bias
        if i < len(parts) - 1:
            np.negative(z, z)
            np.exp(z, z)
            z += 1.0
            np.reciprocal(z, z)
        else:
            z -= z.max(axis=1, keepdims=True)
            np.exp(z, z)
            z /= z.sum(axis=1, keepdims=True)
        out.append(z)
    return out


def loss_and_gradient(weights: np.ndarray, layers: list, x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted sums over the rows: cross entropy, then its gradient."""
    parts = _layers(weights, layers)
    out = _outputs(x, parts)
    target = np.stack([label == 0, label == 1], axis=1).astype(float)
    loss = -float(weight @ (target * np.log(out[-1])).sum(axis=1))
    delta, found = (out[-1] - target) * weight[:, None], []
    for i in range(len(parts) - 1, -1, -1):
        found += [delta.sum(axis=0), (out[i].T @ delta).ravel()]
        if i:
            delta = delta @ parts[i][0].T
            delta *= out[i]
            delta *= 1.0 - out[i]
    return np.concatenate([[loss], *found[::-1]])


def validation_loss(weights: np.ndarray, layers: list, x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Sum over the rows of the negative logarithm of the right class's probability, and their number."""
    p = _outputs(x, _layers(weights, layers))[-1][:, 1]
    return np.array([-np.log(np.maximum(np.where(label == 1, p, 1.0 - p), LEAST)).sum(), len(x)])


def _evaluated(jobs: dict, asked: dict, width: int):
    """Sums of every network asked for: ``asked`` is network -> (training rows or validation rows, weights)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _bytes(batch.column("x")).view("<f8").reshape(-1, width)
            label, weight = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
            for training in {t for t, _ in asked.values()}:
                rows = np.flatnonzero((weight > 0) == training)
                for at in range(0, len(rows), CHUNK):
                    some = rows[at:at + CHUNK]
                    own, seen = x[some], {}
                    for i, (kind, weights) in asked.items():
                        if kind != training:
                            continue
                        columns, layers = jobs[i]
                        if columns not in seen:
                            seen[columns] = own.take(columns, axis=1)
                        found = loss_and_gradient(weights, layers, seen[columns], label[some], weight[some]) if training \
                            else validation_loss(weights, layers, seen[columns], label[some])
                        sums[i] = sums[i] + found if i in sums else found
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([part] * len(sums), pa.int32()),
                                          pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                         names=["network", "part", "sums"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the sums of each network, whose rows come one after the other."""
    key, total = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([0], pa.int32()),
                                           pa.array([total.tobytes()], pa.binary())], names=["network", "part", "sums"])

    for batch in batches:
        for i, s in zip(batch.column("network").to_pylist(), batch.column("sums").to_pylist()):
            found = np.frombuffer(s)
            if i == key:
                total = total + found
                continue
            if key is not None:
                yield row()
            key, total = i, found
    if key is not None:
        yield row()


_SUMS = "network int, part int, sums binary"


# --- L-BFGS -------------------------------------------------------------------------

class _Failed(Exception):
    """A search that found no step."""


Asking = Generator[np.ndarray, tuple, tuple]        # weights go out, their (loss, gradient) come in


def _between(a: tuple, b: tuple) -> float:
    """The least point of the cubic through two (step, loss, slope), kept off their ends."""
    if a[0] > b[0]:
        a, b = b, a
    d1 = a[2] + b[2] - 3 * (a[1] - b[1]) / (a[0] - b[0])
    square = d1 * d1 - a[2] * b[2]
    d2 = math.sqrt(square) if square >= 0 else math.nan
    below = b[2] - a[2] + 2 * d2
    t = b[0] - (b[0] - a[0]) * (b[2] + d2 - d1) / below if below else math.nan
    low, high = a[0] + 0.1 * (b[0] - a[0]), a[0] + 0.9 * (b[0] - a[0])
    return low if t < low else high if t > high else t


def _step_size(x: np.ndarray, loss: float, gradient: np.ndarray, way: np.ndarray, t: float) -> Asking:
    """A step along ``way`` with the strong Wolfe conditions, and what was found there."""
    slope = float(gradient @ way)
    if slope > 0:
        raise _Failed("not a way down")

    def too_high(at):
        return at[1] > loss + 1e-4 * at[0] * slope

    low, ends = (0.0, loss, slope), None
    for i in range(TRIALS):
        found = yield x + way * t
        at = t, found[0], float(found[1] @ way)
        if not math.isfinite(at[1]):
            t /= 2.0
            continue
        if too_high(at) or (at[1] >= low[1] and i > 0):
            ends = low, at
            break
        if abs(at[2]) <= 0.9 * abs(slope):
            return t, found
        if at[2] >= 0:
            ends = at, low
            break
        low, t = at, t * 1.5
    if ends is None:
        raise _Failed("no step in the trials")
    low, high = ends
    for _ in range(TRIALS):
        t = _between(low, high)
        found = yield x + way * t
        at = t, found[0], float(found[1] @ way)
        if too_high(at) or at[1] >= low[1]:
            high = at
            continue
        if abs(at[2]) <= 0.9 * abs(slope):
            return t, found
        if at[2] * (high[0] - low[0]) >= 0:
            high = low
        low = at
    raise _Failed("no step between two trials")


def _way(gradient: np.ndarray, past: list) -> np.ndarray:
    """The quasi-Newton direction from past (step, change of the gradient), newest first."""
    way, shares = gradient.copy(), []
    if past and not past[0][0] @ past[0][1] >= 0:
        raise _Failed("the loss isn't convex along the last step")
    for s, y in past:
        shares.append((s @ way) / (s @ y))
        if math.isnan(shares[-1]):
            raise _Failed("a past step without a change")
        way -= shares[-1] * y
    if past:
        way *= (past[0][0] @ past[0][1]) / (past[0][1] @ past[0][1])
    for (s, y), share in zip(past[::-1], shares[::-1]):
        way += (share - (y @ way) / (s @ y)) * s
    return -way


def descent(x: np.ndarray, found: tuple | None, steps: int, tol: float) -> Asking:
    """At most ``steps`` steps of L-BFGS from ``x`` (``found``: its loss and gradient, if known); ends there likewise."""
    loss, gradient = found if found is not None else (yield x)
    first, done, failed, past, losses = loss, 0, False, [], [math.inf]
    while not (done >= steps or (len(losses) > 1 and abs(loss - max(losses)) <= tol * abs(first))
               or np.linalg.norm(gradient) <= max(tol * loss, 1e-8)):
        try:
            with np.errstate(invalid="ignore", divide="ignore"):
                way = _way(gradient, past)
            t, new = yield from _step_size(x, loss, gradient, way, 1.0 if done else 1.0 / np.linalg.norm(way))
            if t * np.linalg.norm(gradient) < 1e-10:
                raise _Failed("too short a step")
        except _Failed:
            if failed:
                break
            failed, past = True, []
            continue
        moved = x + way * t
        past = [(moved - x, new[1] - gradient), *past][:MEMORY]
        x, (loss, gradient) = moved, new
        failed, done, losses = False, done + 1, [*losses, loss][-LOSSES:]
    return x, (loss, gradient)


def _rounds(job: NetworkJob) -> Generator[tuple, object, tuple]:
    """Rounds of ``step`` steps until the validation loss has not fallen for ``patience`` rounds; the best round's
    weights and steps. Asks by (training rows or validation rows, weights)."""
    x, found, best = job.weights, None, None
    for done in range(job.step, job.max_iter + job.step, job.step):
        search, answer = descent(x, found, min(job.step, job.max_iter - done + job.step), job.tol), None
        try:
            while True:
                answer = yield True, search.send(answer)
        except StopIteration as end:
            x, found = end.value
        loss = yield False, x
        if best is None or loss < best[0]:
            best = (loss, x, min(done, job.max_iter), done)
        elif done - best[3] >= job.patience * job.step:
            break
    return best[1], best[2]


def fit_networks(rows: DataFrame, width: int, jobs: list) -> list:
    """Train all ``jobs`` on ``packed`` rows; (weights, steps) of each one's best round."""
    spark = rows.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/networks-{uuid.uuid4().hex}"
    rows.write.parquet(f"{folder}/dealt")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/dealt")
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("blocks"), F.count_if(F.col("weight") == 0).alias("held")).first()
    if not count["blocks"] or not count["held"]:
        raise ValueError("networks need training and validation rows")
    blocks, tasks = round(count["blocks"]), task_count(count["n"], len(jobs))
    if tasks != rows.rdd.getNumPartitions():
        rows.repartition(tasks).write.parquet(f"{folder}/rows")
        rows = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    parts = rows.rdd.getNumPartitions()
    shapes = {i: (tuple(j.columns), list(j.layers)) for i, j in enumerate(jobs)}
    runs, asked, ended = {i: _rounds(j) for i, j in enumerate(jobs)}, {}, {}

    def go_on(i, answer):
        try:
            asked[i] = runs[i].send(answer)
        except StopIteration as end:
            ended[i] = end.value
            asked.pop(i, None)

    for i in runs:
        go_on(i, None)
    while asked:
        sums = rows.mapInArrow(_evaluated(shapes, asked, width), _SUMS)
        size = sum(8 * len(w) for _, w in asked.values())
        if parts * size > SUMS_BYTES:
            sums = sums.repartition(min(len(asked), 1 + parts * size // SUMS_BYTES), "network") \
                .sortWithinPartitions("network", "part").mapInArrow(_added, _SUMS)
        total: dict[int, np.ndarray] = {}
        for r in sorted(sums.collect(), key=lambda r: (r.network, r.part)):        # the size of the weights a task
            found = np.frombuffer(bytes(r.sums))
            total[r.network] = total[r.network] + found if r.network in total else found
        for i, (training, _) in dict(asked).items():
            v = total[i]
            go_on(i, (float(v[0]) / blocks, v[1:] / blocks) if training else float(v[0] / v[1]))
    return [ended[i] for i in range(len(jobs))]
