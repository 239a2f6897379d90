"""Per-feature contributions of a boosted-tree model (class-1 margin).

Path-dependent Shapley values, computed leaf by leaf:

* For one leaf with value v and path features D, the game is
  v(S) = v * prod_{d in S} a_d(x) * prod_{d not in S} r_d, where a_d(x) is 1
  when the row satisfies every path condition on feature d and r_d is the
  product of the path's cover fractions on d. Feature i gets
  v (a_i - r_i) sum_s w_s c_s, where c_s are the coefficients of
  prod_{d != i} (r_d + a_d z) and w_s the Shapley weights. The product over all
  of D is made once (extend), each feature's factor is divided out again
  (unwind): the square of a path's features a row, for paths of any length.
* Rows: Arrow batches are scored leaf by leaf with numpy; a row gets one
  array of per-feature sums, so nothing is multiplied by the leaf count and
  nothing is shuffled. The leaves go to the tasks with the model.

The sum of a row's contributions plus the bias (the cover-weighted mean
margin) equals the model's margin for that row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from . import boosting as BO
from .models import FEATURES, FittedModel


@dataclass
class Leaf:
    """A leaf's value, and per feature of its path the tests and the product of cover fractions."""
    value: float
    features: list
    tests: list           # per feature: a list of tests, all of which hold where the path is taken
    ratios: list

    @staticmethod
    def of(value: float, steps: list) -> "Leaf":
        """``steps``: (feature, test, cover fraction) from the root down."""
        features = list(dict.fromkeys(s[0] for s in steps))
        return Leaf(value, features, [[s[1] for s in steps if s[0] == f] for f in features],
                    [math.prod(s[2] for s in steps if s[0] == f) for f in features])


def node_rows(fitted: FittedModel, path: str | None = None) -> list:
    """Collect the node table of the ensemble (model-sized)."""
    import uuid

    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if path is None:
        path = f"{ensure_checkpoint_dir(spark)}/nodes-{uuid.uuid4().hex}"
    fitted.model.write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data")
    nd = F.col("nodeData")
    return raw.select(F.col("treeID").alias("tree"), nd["id"].alias("id"), nd["prediction"].alias("value"),
                      nd["rawCount"].alias("cover"), nd["leftChild"].alias("left"),
                      nd["rightChild"].alias("right"), nd["split"]["featureIndex"].alias("fi"),
                      nd["split"]["leftCategoriesOrThreshold"].alias("lct"),
                      nd["split"]["numCategories"].alias("ncat")).collect()


def _shapley_weights(m: int) -> list:
    return [1.0 / (m * math.comb(m - 1, s)) for s in range(m)]


def leaf_values(met: np.ndarray, ratios, value: float) -> np.ndarray:
    """Shapley values (rows x features) of one leaf; ``met`` says which of its features' tests each row passes."""
    n, m = met.shape
    product = np.zeros((n, m + 1))
    product[:, 0] = 1.0
    for d, r in enumerate(ratios):                        # times (r + a z)
        product[:, 1:d + 2] = product[:, 1:d + 2] * r + met[:, d:d + 1] * product[:, :d + 1]
        product[:, 0] *= r
    weights, out = _shapley_weights(m), np.zeros((n, m))
    for i, r in enumerate(ratios):
        yes = met[:, i]
        total = np.zeros(n)
        # a = 1: divide by (r + z) from the top, which does not grow as r <= 1.
        c = np.zeros(int(yes.sum()))
        top = product[yes]
        for s in range(m - 1, -1, -1):
            c = top[:, s + 1] - r * c
            total[yes] += weights[s] * c
        if r > 0:                                         # a = 0: divide by r; with r = 0 too the feature gets nothing
            total[~yes] = (product[~yes][:, :m] / r) @ np.array(weights)
        out[:, i] = value * (yes - r) * total
    return out


def _spark_leaves(fitted: FittedModel, path: str | None) -> list:
    """Leaves of Spark's own ensemble; a test is (is numeric, threshold, categories, goes left)."""
    weights = list(fitted.model.treeWeights)
    by_tree = {}
    for r in node_rows(fitted, path):
        by_tree.setdefault(r.tree, {})[r.id] = r
    leaves = []
    limit = fitted.n_trees or len(weights)     # an early-stopping cut keeps the first trees
    for t, nodes in sorted(by_tree.items()):
        if t >= limit:
            continue

        def walk(node_id, steps):
            n = nodes[node_id]
            if n.left < 0:
                leaves.append(Leaf.of(weights[t] * n.value, steps))
                return
            numeric = n.ncat < 0
            thr = float(n.lct[0]) if numeric and n.lct else None
            cats = None if numeric else [float(x) for x in n.lct]
            for child, go_left in ((n.left, True), (n.right, False)):
                ratio = nodes[child].cover / n.cover if n.cover else 0.0
                walk(child, steps + [(n.fi, (numeric, thr, cats, go_left), ratio)])
        walk(0, [])
    return leaves


def _boosted_leaves(model: BO.Boosted, n_trees: int | None) -> list:
    """Leaves of a boosted preset; a test is a flag per bin."""
    leaves = []
    for tree in model.trees[:n_trees]:
        def walk(i, steps):
            n = tree[i]
            if n.feature < 0:
                leaves.append(Leaf.of(n.value, steps))
                return
            left = np.frombuffer(n.left_bins, np.bool_)
            for child, flags in ((n.left, left), (n.right, ~left)):
                walk(child, steps + [(n.feature, flags, tree[child].cover / n.cover if n.cover else 0.0)])
        walk(0, [])
    return leaves


def model_leaves(fitted: FittedModel, path: str | None = None) -> tuple[list, float]:
    """(leaves, bias) of a boosted ensemble."""
    if isinstance(fitted.model, BO.Boosted):
        leaves, start = _boosted_leaves(fitted.model, fitted.n_trees), fitted.model.base
    else:
        leaves, start = _spark_leaves(fitted, path), 0.0
    return leaves, start + sum(leaf.value * math.prod(leaf.ratios) for leaf in leaves)


def _passes(x: np.ndarray, test) -> np.ndarray:
    if isinstance(test, np.ndarray):
        return test[x]
    numeric, threshold, cats, left = test
    return (x <= threshold if numeric else np.isin(x, cats)) == left


def _row_sums(leaves: list, n_features: int, keys: list, grid):
    def run(batches):
        for batch in batches:
            x = grid(batch.column("__x"))
            sums = np.zeros((len(x), n_features))
            for leaf in leaves:
                if leaf.features:
                    met = np.stack([np.logical_and.reduce([_passes(x[:, f], t) for t in tests])
                                    for f, tests in zip(leaf.features, leaf.tests)], axis=1)
                    sums[:, leaf.features] += leaf_values(met, leaf.ratios, leaf.value)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys],
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * n_features, pa.int32()), pa.array(sums.ravel()))],
                names=[*keys, "contributions"])
    return run


def row_contributions(fitted: FittedModel, rows: DataFrame, row_keys, path: str | None = None) -> DataFrame:
    """(row keys..., contributions array<double> in the order of ``fitted.feature_names``) for every row."""
    leaves, _ = model_leaves(fitted, path)
    keys, width = list(row_keys), len(fitted.feature_names)
    if isinstance(fitted.model, BO.Boosted):
        enc = BO.binned(rows, fitted.model.bins, keys).withColumnRenamed("__bins", "__x")

        def grid(column):
            return BO.grid_of(column, width)
    else:
        enc = fitted.prep.transform(rows).select(*keys, vector_to_array(F.col(FEATURES)).alias("__x"))

        def grid(column):
            return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    schema = T.StructType([enc.schema[k] for k in keys]
                          + [T.StructField("contributions", T.ArrayType(T.DoubleType()))])
    return enc.mapInArrow(_row_sums(leaves, width, keys, grid), schema)


def contributions(fitted: FittedModel, rows: DataFrame, row_keys, path: str | None = None) -> DataFrame:
    """(row keys..., feature, contribution) for every row and every feature (0 where no leaf uses it);
    the bias is returned separately by ``model_leaves``."""
    names = F.array(*[F.lit(n) for n in fitted.feature_names])
    wide = row_contributions(fitted, rows, row_keys, path)
    return wide.select(*row_keys, F.explode(F.arrays_zip(names.alias("feature"), F.col("contributions"))).alias("c")) \
        .select(*row_keys, F.col("c.feature").alias("feature"), F.col("c.contributions").alias("contribution"))


def contribution_summary(contrib: DataFrame) -> DataFrame:
    """Mean absolute contribution of every feature with its rank (one row per feature, so the window is small)."""
    w = Window.orderBy(F.desc("mean_abs"), "feature")
    return (contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
            .withColumn("rank", F.row_number().over(w)))
