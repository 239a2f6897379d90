"""Gradient-boosted trees from grouped histograms, for many models in one pass over the rows.

The table is binned once (a byte per feature, 0 = missing) and written. A
round grows one tree of every model: each task adds its rows' gradients and
hessians up by (model, open node, feature, bin), Spark adds the tasks' sums up
by (model, node), and the split is found where the sums meet, so a level of
all trees of all models is one job, and only splits reach the driver. Models
differ in parameters, seed and the features they may use; a sweep over feature
sets therefore reads the rows as often as its longest model does, not once a
model.

Missing values: both sides are tried for them at every split, and the better
one is the node's default direction. Categories are split by a set of levels,
in order of gradient over hessian. With ``max_leaves`` a tree grows best first:
a level's nodes are all looked at, then splits are taken by gain until the cap
is reached, which is the tree that node-by-node growth makes.

Margins are written every ``REWRITE`` rounds; between two writes the newest
trees are applied on the way. What goes to the tasks has the size of the
models.
"""

from __future__ import annotations

import heapq
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

MAX_BINS = 64
#: Levels of one category column at most (a bin is a byte).
MAX_LEVELS = 254
#: Rounds between two writes of the margins.
REWRITE = 10
#: Training rows times models of one task, its rows at least, and bytes of sums (of one source task) that meet in one.
TASK_ROWS, LEAST_ROWS, SUMS_BYTES = 1 << 16, 1 << 12, 8 << 20
NODE_SCHEMA = ("tree_id int, node_id int, feature string, threshold double, categories array<string>, yes int, no int, "
               "missing int, gain double, cover double, leaf double")


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 10
    rate: float = 0.01
    max_depth: int = 5
    max_leaves: int | None = None       # None: every node that gains is split
    row_share: float = 1.0              # rows drawn anew for every tree
    col_share: float = 1.0              # features drawn anew for every tree
    reg_lambda: float = 0.0
    min_hessian: float = 1.0            # least sum of hessians in a child
    min_rows: int = 1                   # least number of rows in a child


@dataclass
class Bins:
    """How one column becomes bins: bin j >= 1 holds values up to ``edges[j - 1]``, or level ``levels[j - 1]``."""
    name: str
    edges: list | None = None
    levels: list | None = None

    @property
    def count(self) -> int:
        return len(self.levels) if self.levels is not None else len(self.edges) + 1

    def place(self, x: np.ndarray) -> np.ndarray:
        """The bins of numbers (NaN: missing)."""
        return np.where(np.isnan(x), 0, np.searchsorted(self.edges, x, side="left") + 1).astype(np.uint8)


@dataclass
class Node:
    feature: int = -1
    left_bins: bytes | None = None      # a flag per bin (0 = missing): goes left
    left: int = -1
    right: int = -1
    missing_left: bool = True
    gain: float = 0.0
    cover: float = 0.0
    value: float = 0.0


@dataclass
class Boosted:
    """A fitted model: base margin and trees over the binned columns."""
    params: BoostParams
    bins: list
    used: list                          # columns (of ``bins``) that this model may split on
    base: float
    trees: list = field(default_factory=list)

    @property
    def names(self) -> list:
        return [self.bins[c].name for c in self.used]

    def importance(self, n_trees: int | None = None) -> dict:
        """Share of the gain by feature (0 where no tree splits on it)."""
        total = dict.fromkeys(self.names, 0.0)
        for tree in self.trees[:n_trees]:
            for n in tree:
                if n.feature >= 0:
                    total[self.bins[n.feature].name] += n.gain
        whole = sum(total.values()) or 1.0
        return {k: v / whole for k, v in total.items()}

    def trimmed(self) -> "Boosted":
        """The same model over its own columns only."""
        new = {c: i for i, c in enumerate(self.used)}
        trees = [[Node(**{**vars(n), "feature": new.get(n.feature, -1)}) for n in t] for t in self.trees]
        return Boosted(self.params, [self.bins[c] for c in self.used], list(range(len(self.used))), self.base, trees)

    def node_rows(self) -> list:
        out = []
        for t, tree in enumerate(self.trees):
            for i, n in enumerate(tree):
                if n.feature < 0:
                    out.append((t, i, None, None, None, None, None, None, None, n.cover, n.value))
                    continue
                b = self.bins[n.feature]
                flags = np.frombuffer(n.left_bins, np.bool_)
                threshold = cats = None
                if b.levels is None:
                    threshold = float(b.edges[int(np.flatnonzero(flags[1:]).max(initial=0))])
                else:
                    cats = [v for v, f in zip(b.levels, flags[1:]) if f]
                out.append((t, i, b.name, threshold, cats, n.left, n.right, n.left if n.missing_left else n.right,
                            n.gain, n.cover, None))
        return out

    def to_json(self) -> str:
        trees = [[{**asdict(n), "left_bins": n.left_bins.hex() if n.left_bins else None} for n in t] for t in self.trees]
        return json.dumps({"params": asdict(self.params), "bins": [asdict(b) for b in self.bins], "used": self.used,
                           "base": self.base, "trees": trees})

    @staticmethod
    def from_json(text: str) -> "Boosted":
        d = json.loads(text)
        trees = [[Node(**{**n, "left_bins": bytes.fromhex(n["left_bins"]) if n["left_bins"] else None}) for n in t]
                 for t in d["trees"]]
        return Boosted(BoostParams(**d["params"]), [Bins(**b) for b in d["bins"]], d["used"], d["base"], trees)


@dataclass
class Job:
    """One model to fit: its parameters, the columns it may use and its seed."""
    params: BoostParams
    used: list
    seed: int


# --- binning --------------------------------------------------------------------

def find_bins(train: DataFrame, numeric, categorical, max_bins: int = MAX_BINS) -> list:
    """Quantile edges of the numeric columns and the levels of the categories, from the training rows."""
    numeric, categorical = list(numeric), list(categorical)
    out = []
    if numeric:
        asked = train.select(*[F.col(c).cast("double").alias(c) for c in numeric])
        probs = [k / max_bins for k in range(1, max_bins)]
        for c, edges in zip(numeric, asked.approxQuantile(numeric, probs, 0.25 / max_bins)):
            out.append(Bins(c, edges=sorted({e for e in edges if not math.isnan(e)})))
    for c in categorical:
        levels = [r[0] for r in train.select(F.col(c).cast("string").alias("v")).filter("v IS NOT NULL").distinct()
                  .orderBy("v").limit(MAX_LEVELS + 1).collect()]
        if len(levels) > MAX_LEVELS:
            raise ValueError(f"{c} has more than {MAX_LEVELS} levels; a boosted model splits on {MAX_LEVELS} at most")
        out.append(Bins(c, levels=levels))
    return out


def binned(rows: DataFrame, bins: list, keep) -> DataFrame:
    """``keep`` columns and ``__bins``, a byte per entry of ``bins``."""
    keep = list(keep)
    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField("__bins", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = np.zeros((batch.num_rows, len(bins)), np.uint8)
            if grid.size:
                values = batch.column("__values").flatten().to_numpy(zero_copy_only=False).reshape(grid.shape)
                for i, b in enumerate(bins):
                    grid[:, i] = b.place(values[:, i]) if b.levels is None else values[:, i]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], binary_rows(grid)], names=[*keep, "__bins"])
    # One array a row: many columns are slow to hand over. A level becomes its number on the way.
    cells = [F.coalesce(F.col(b.name).cast("double"), F.lit(float("nan"))) if b.levels is None
             else F.coalesce(F.array_position(F.array(*[F.lit(v) for v in b.levels]), F.col(b.name).cast("string")), F.lit(0)).cast("double")
             if b.levels else F.lit(0.0) for b in bins]
    values = F.array(*cells) if cells else F.array().cast("array<double>")
    return rows.select(*keep, values.alias("__values")).mapInArrow(run, schema)


def binary_rows(grid: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    grid = np.ascontiguousarray(grid)
    ends = np.arange(len(grid) + 1, dtype=np.int64) * (grid.shape[1] * grid.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(grid), [None, pa.py_buffer(ends), pa.py_buffer(grid)]).cast(pa.binary())


def _bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column, one value after the other, where they lie."""
    if not len(column):
        return np.zeros(0, np.uint8)
    size = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], size)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)


def grid_of(column: pa.Array, width: int) -> np.ndarray:
    return _bytes(column).reshape(len(column), width)


# --- trees on binned rows ----------------------------------------------------------

class Walk:
    """A tree as arrays: rows go down it together, a level at a time."""

    def __init__(self, tree: list):
        self.value = np.array([n.value for n in tree])
        self.feature = np.array([n.feature for n in tree])
        self.child = np.array([[n.right, n.left] for n in tree])
        none = bytes(256)
        left = np.frombuffer(b"".join(n.left_bins or none for n in tree), np.bool_).reshape(len(tree), 256)
        # The next node by node and bin; a leaf is its own next, whatever column is looked at.
        inner = self.feature >= 0
        here = np.arange(len(tree))[:, None]
        self.next = np.where(inner[:, None], np.where(left, self.child[:, 1:], self.child[:, :1]), here).astype(np.intp).ravel()
        self.column = np.where(inner, self.feature, 0).astype(np.intp)
        self.depth, open_nodes = 0, [0] if inner[0] else []
        while open_nodes:
            self.depth += 1
            open_nodes = [c for n in open_nodes for c in (tree[n].left, tree[n].right) if inner[c]]

    def where(self, grid: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        at = np.zeros(len(grid), np.intp)
        if not self.depth or not len(grid):
            return at
        cells, first = grid.ravel(), np.arange(len(grid)) * grid.shape[1]
        for _ in range(self.depth):
            at = self.next.take((at << 8) + cells.take(first + self.column.take(at)))
        return at

    def values(self, grid: np.ndarray) -> np.ndarray:
        return self.value[self.where(grid)]


def margins(model: Boosted, grid: np.ndarray, n_trees: int | None = None) -> np.ndarray:
    out = np.full(len(grid), model.base)
    for tree in model.trees[:n_trees]:
        out += Walk(tree).values(grid)
    return out


def _drawn(row_hash: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: a hash of the row, the model's seed and the tree below the share."""
    if share >= 1:
        return np.ones(len(row_hash), bool)
    x = row_hash.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03) % 2**64)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(share * 2**64), 2**64 - 1))


def _columns(job: Job, tree: int) -> list:
    """The features a tree may split on."""
    k = max(1, math.ceil(job.params.col_share * len(job.used)))
    rng = np.random.default_rng([job.seed, tree])
    return sorted(rng.choice(job.used, size=k, replace=False).tolist()) if k < len(job.used) else list(job.used)


@dataclass
class _Open:
    """What the tasks need of one model at one level."""
    job: int
    seed: int
    tree: int
    share: float
    recent: list          # finished trees that the written margins lack
    growing: Walk
    nodes: list           # open nodes of the growing tree
    columns: list


def _histograms(opened: list, width: int, slots: int, n_jobs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}         # by model: node, column, (gradient, hessian, rows), bin
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = grid_of(batch.column("__bins"), width)
            base = _bytes(batch.column("__margins")).view("<f8").reshape(-1, n_jobs)
            label, row_hash = batch.column("label").to_numpy(), batch.column("__row").to_numpy()
            for o in opened:
                m = base[:, o.job].copy()
                for walk in o.recent:
                    m += walk.values(grid)
                p = 1.0 / (1.0 + np.exp(-m))
                place = np.full(len(o.growing.value), -1)
                place[o.nodes] = np.arange(len(o.nodes))
                at = place[o.growing.where(grid)]
                rows = np.flatnonzero((at >= 0) & _drawn(row_hash, o.seed, o.tree, o.share))
                g, h, at = (p - label)[rows], (p * (1 - p))[rows], at[rows]
                size, first = len(o.nodes) * slots, at * slots
                if o.job not in sums:
                    sums[o.job] = np.zeros((len(o.nodes), len(o.columns), 3, slots))
                whole = sums[o.job]
                for k, c in enumerate(o.columns):
                    spot = first + grid[rows, c]
                    for i, weights in enumerate((g, h, None)):
                        whole[:, k, i] += np.bincount(spot, weights, size).reshape(-1, slots)
        if sums:
            found = [(o.job, node, part) for o in opened for node, part in zip(o.nodes, sums[o.job])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([j for j, _, _ in found], pa.int32()), pa.array([n for _, n, _ in found], pa.int32()),
                 pa.array([v.tobytes() for _, _, v in found], pa.binary())], names=["job", "node", "sums"])
    return run


def _score(g, h, lam):
    return np.where(h + lam > 0, g * g / np.maximum(h + lam, 1e-300), 0.0)


def best_split(sums: np.ndarray, columns: list, is_level: list, params: BoostParams) -> dict:
    """The best split of a node from its (feature, (gradient, hessian, rows), bin) sums; gain 0 if none."""
    g, h, n = sums[0].sum(1)
    lam, slots = params.reg_lambda, sums.shape[2]
    parent = float(_score(g, h, lam))
    best = {"gain": 0.0, "g": float(g), "h": float(h), "feature": -1}
    for part, c in zip(sums, columns):
        order = np.arange(1, slots)
        if is_level[c]:
            order = order[part[2, 1:] > 0]
            order = order[np.argsort(part[0, order] / np.maximum(part[1, order], 1e-300), kind="stable")]
        if len(order) < 1:
            continue
        below = np.cumsum(part[:, order], axis=1)
        for with_missing in (True, False):
            gl, hl, nl = below + part[:, :1] * with_missing
            gr, hr, nr = g - gl, h - hl, n - nl
            gain = _score(gl, hl, lam) + _score(gr, hr, lam) - parent
            fit = (np.minimum(hl, hr) >= params.min_hessian) & (np.minimum(nl, nr) >= max(params.min_rows, 1))
            gain = np.where(fit, gain, 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best["gain"] + 1e-12 * max(parent, 1.0):
                flags = np.zeros(256, np.bool_)
                flags[order[:k + 1]] = True
                default = with_missing if part[2, 0] else bool(hl[k] >= hr[k])    # none missing: the larger side
                flags[0] = default
                if is_level[c]:                                                  # levels not seen here go with them
                    flags[1:slots][part[2, 1:] == 0] = default
                best = {**best, "gain": float(gain[k]), "feature": int(c), "left_bins": flags.tobytes(), "missing_left": default,
                        "gl": float(gl[k]), "hl": float(hl[k])}
    return best


def _splits(per_job: dict, slots: int, is_level: list):
    """Adds up the sums of each (job, node), whose rows come one after the other, and finds its split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, rows = None, None, []

        def row():
            columns, params = per_job[key[0]]
            return {"job": key[0], "node": key[1], **best_split(total, columns, is_level, params)}

        for batch in batches:
            for j, n, s in zip(*(batch.column(c).to_pylist() for c in ("job", "node", "sums"))):
                part = np.frombuffer(s, np.float64).reshape(-1, 3, slots)
                if key == (j, n):
                    total = total + part
                    continue
                if key is not None:
                    rows.append(row())
                key, total = (j, n), part
        if key is not None:
            rows.append(row())
        yield pa.RecordBatch.from_pylist(rows, schema=_SPLITS)         # a row an open node: the size of a tree's level
    return run


_SPLITS = pa.schema([("job", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("g", pa.float64()), ("h", pa.float64()),
                     ("feature", pa.int32()), ("left_bins", pa.binary()), ("missing_left", pa.bool_()), ("gl", pa.float64()),
                     ("hl", pa.float64())])
SPLIT_SCHEMA = "job int, node int, gain double, g double, h double, feature int, left_bins binary, missing_left boolean, gl double, hl double"


def _best_first(tree: list, cap: int | None) -> list:
    """The tree that splitting by gain until ``cap`` leaves makes of one whose nodes have all been looked at."""
    out = [Node(**{**vars(tree[0]), "left": -1, "right": -1, "feature": -1})]
    heap = [(-tree[0].gain, 0, 0)] if tree[0].feature >= 0 else []
    leaves = 1
    while heap and (cap is None or leaves < cap):
        _, i, new = heapq.heappop(heap)
        n = tree[i]
        out[new] = Node(**{**vars(n), "left": len(out), "right": len(out) + 1})
        for child in (n.left, n.right):
            c = tree[child]
            out.append(Node(**{**vars(c), "left": -1, "right": -1, "feature": -1}))
            if c.feature >= 0:
                heapq.heappush(heap, (-c.gain, child, len(out) - 1))
        leaves += 1
    for n in out:
        if n.feature < 0:
            n.left_bins, n.gain = None, 0.0
    return out


def _rewritten(state: DataFrame, recent: list, width: int, path: str) -> DataFrame:
    n_jobs = len(recent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = grid_of(batch.column("__bins"), width)
            m = _bytes(batch.column("__margins")).view("<f8").reshape(-1, n_jobs).copy()
            for j, trees in enumerate(recent):
                for walk in trees:
                    m[:, j] += walk.values(grid)
            arrays = [batch.column(c) if c != "__margins" else binary_rows(m) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)
    state.mapInArrow(run, state.schema).write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def task_count(rows: int, models: int) -> int:
    """Tasks of a level: by rows times models, as a task looks at each row once a model."""
    return 1 + min(rows * models // TASK_ROWS, rows // min(LEAST_ROWS, TASK_ROWS))


def fit_boosted(train: DataFrame, bins: list, jobs: list, row_keys, label: str = "label") -> list:
    """Fit all ``jobs`` on ``train`` (``row_keys``, label and ``__bins``); a list of ``Boosted``.

    ``row_keys`` name a row, so that the rows a tree draws don't hinge on how the table is partitioned.
    """
    spark = train.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/boosting-{uuid.uuid4().hex}"
    total = train.agg(F.sum(label).alias("p"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"] or total["p"] in (0, total["n"]):
        raise ValueError("boosting needs training rows of both classes")
    base = math.log(total["p"] / (total["n"] - total["p"]))
    models = [Boosted(j.params, bins, list(j.used), base) for j in jobs]
    width, slots = len(bins), max(b.count for b in bins) + 1
    is_level = [b.levels is not None for b in bins]
    start = np.full(len(jobs), base).astype("<f8").tobytes()
    state = train.select("__bins", F.col(label).cast("long").alias("label"), F.xxhash64(*row_keys).alias("__row"),
                         F.lit(bytearray(start)).alias("__margins"))
    state.repartition(task_count(total["n"], len(jobs))).write.parquet(f"{folder}/0")
    state = spark.read.schema(state.schema).parquet(f"{folder}/0")
    tasks = state.rdd.getNumPartitions()
    written, recent = 0, [[] for _ in jobs]         # trees that the written margins hold, and those that they lack
    for t in range(max(j.params.rounds for j in jobs)):
        if t - written == REWRITE:
            state = _rewritten(state, recent, width, f"{folder}/{t}")
            tasks = state.rdd.getNumPartitions()
            written, recent = t, [[] for _ in jobs]
        live = [j for j, job in enumerate(jobs) if job.params.rounds > t]
        growing = {j: [Node()] for j in live}
        columns = {j: _columns(jobs[j], t) for j in live}
        frontier = {j: [0] for j in live}
        for level in range(max(jobs[j].params.max_depth for j in live)):
            opened = [_Open(j, jobs[j].seed, t, jobs[j].params.row_share, recent[j], Walk(growing[j]), frontier[j], columns[j])
                      for j in live if frontier[j] and level < jobs[j].params.max_depth]
            if not opened:
                break
            size = sum(len(o.nodes) * len(o.columns) for o in opened) * 3 * 8 * slots
            sums = _histograms(opened, width, slots, len(jobs))
            splits = _splits({j: (columns[j], jobs[j].params) for j in live}, slots, is_level)
            if tasks == 1:                  # the sums of a single task are whole as they are
                found = state.mapInArrow(lambda rows: splits(sums(rows)), SPLIT_SCHEMA).collect()
            else:
                met = state.mapInArrow(sums, "job int, node int, sums binary") \
                    .repartition(1 + size // SUMS_BYTES, "job", "node").sortWithinPartitions("job", "node")
                found = met.mapInArrow(splits, SPLIT_SCHEMA).collect()
            frontier = {j: [] for j in live}
            for r in sorted(found, key=lambda r: (r.job, r.node)):       # a row an open node
                tree, p = growing[r.job], jobs[r.job].params
                n = tree[r.node]
                if r.node == 0:
                    n.cover, n.value = r.h, _leaf(r.g, r.h, p)
                if r.feature < 0:
                    continue
                n.feature, n.gain, n.left_bins, n.missing_left = r.feature, r.gain, bytes(r.left_bins), r.missing_left
                n.left, n.right = len(tree), len(tree) + 1
                tree += [Node(cover=h, value=_leaf(g, h, p)) for g, h in ((r.gl, r.hl), (r.g - r.gl, r.h - r.hl))]
                frontier[r.job] += [n.left, n.right]
        for j in live:
            models[j].trees.append(_best_first(growing[j], jobs[j].params.max_leaves))
            recent[j].append(Walk(models[j].trees[-1]))
    return models


def _leaf(g: float, h: float, p: BoostParams) -> float:
    return -p.rate * g / (h + p.reg_lambda) if h + p.reg_lambda > 0 else 0.0


# --- scoring -------------------------------------------------------------------------

def scores(rows: DataFrame, models: dict, keep) -> DataFrame:
    """(``keep``..., model, prob) of every row (with ``__bins``) and every entry of ``models``: name -> (Boosted, trees used)."""
    keep = list(keep)
    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField("model", T.StringType()),
                                                            T.StructField("prob", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, (model, n) in models.items():
                grid = grid_of(batch.column("__bins"), len(model.bins))
                prob = 1.0 / (1.0 + np.exp(-margins(model, grid, n)))
                yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array([name] * len(grid), pa.string()),
                                                  pa.array(prob)], names=[*keep, "model", "prob"])
    return rows.select(*keep, "__bins").mapInArrow(run, schema)


def prefix_scores(rows: DataFrame, models: dict, label: str = "label") -> DataFrame:
    """(model, prefix, label, score): the margin of every row by the first 1, 2, ... trees of every model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, model in models.items():
                grid = grid_of(batch.column("__bins"), len(model.bins))
                m = np.full(len(grid), model.base)
                for k, tree in enumerate(model.trees, 1):
                    m = m + Walk(tree).values(grid)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grid), pa.string()), pa.array(np.full(len(grid), k), pa.int32()),
                                                      batch.column("label"), pa.array(m)], names=["model", "prefix", "label", "score"])
    return rows.select(F.col(label).cast("int").alias("label"), "__bins").mapInArrow(
        run, "model string, prefix int, label int, score double")


def node_table(spark: SparkSession, model: Boosted, n_trees: int | None = None) -> DataFrame:
    """The nodes of a model, with the default direction of missing values (``missing``)."""
    rows = [r for r in model.node_rows() if n_trees is None or r[0] < n_trees]
    return spark.createDataFrame(rows, NODE_SCHEMA)
