"""Model registry, validation-set grid search, scoring and model tables.

Each preset is a factory (of a Spark ML estimator, or of boosting parameters)
plus its (single-valued, as shipped) grid. Training data are the ``train`` rows of a split table; the
grid is scored by exact AUC on the ``validation`` rows (not a random
re-split); the winning model is kept and scores ``validation`` and ``test``.
"""

from __future__ import annotations

import json
import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel, classification
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets as P
from ..session import ensure_checkpoint_dir
from . import boosting as BO
from . import metrics as ME
from . import networks as NE
from .features import assemble_stages

FEATURES = "features"
#: Grid entries that are fitted at a time, as concurrent jobs over one encoded table.
PARALLEL_FITS = 4
#: Iterations of a network between two looks at the validation loss.
NETWORK_STEP = 5


def _known(params: dict, *names: str) -> dict:
    """The parameters, all of which the preset reads; another key raises, as it would change nothing."""
    extra = set(params) - set(names)
    if extra:
        raise KeyError(f"grid keys {sorted(extra)} are not read by this preset; it reads {sorted(names)}")
    return params


@dataclass
class ModelPreset:
    name: str
    encoding: str                 # onehot | index | bins (boosted here, see ``boosting``)
    grid: list                    # list of dicts: estimator param name -> value
    build: callable               # (seed, n_train, n_features) -> estimator
    scale: bool = False           # standardise the vector first (networks)
    notes: str = ""
    extra: dict = field(default_factory=dict)


def _lr(params, seed, n, d):
    _known(params, "C", "penalty")
    c = params.get("C", 1.0)
    penalty = params.get("penalty", "l1")
    return LogisticRegression(featuresCol=FEATURES, labelCol="label", maxIter=500, tol=1e-4,
                              regParam=1.0 / (c * max(n, 1)), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=False, probabilityCol="__proba")


def _rf(params, seed, n, d):
    _known(params, "numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy", "subsamplingRate")
    return RandomForestClassifier(featuresCol=FEATURES, labelCol="label", seed=seed,
                                  numTrees=params.get("numTrees", 50), maxDepth=params.get("maxDepth", 5),
                                  minInstancesPerNode=params.get("minInstancesPerNode", 1),
                                  featureSubsetStrategy=str(params.get("featureSubsetStrategy", "sqrt")),
                                  subsamplingRate=params.get("subsamplingRate", 1.0), maxBins=64,
                                  probabilityCol="__proba")


def _gbt(rounds, rate, subsample):
    def build(params, seed, n, d):
        _known(params, "maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy",
               "minInstancesPerNode")
        est = GBTClassifier(featuresCol=FEATURES, labelCol="label", seed=seed,
                            maxIter=params.get("maxIter", rounds), maxDepth=params.get("maxDepth", 5),
                            stepSize=params.get("stepSize", rate),
                            subsamplingRate=params.get("subsamplingRate", subsample),
                            featureSubsetStrategy=str(params.get("featureSubsetStrategy", "0.5")),
                            minInstancesPerNode=params.get("minInstancesPerNode", 1), maxBins=64)
        return est.setProbabilityCol("__proba")
    return build


def _boost(**base):
    def build(params, seed, n, d):
        _known(params, "maxIter", "maxDepth", "stepSize", "maxLeaves", "subsamplingRate", "columnRate", "regLambda",
               "minHessian", "minRows")
        names = {"maxIter": "rounds", "maxDepth": "max_depth", "stepSize": "rate", "maxLeaves": "max_leaves",
                 "subsamplingRate": "row_share", "columnRate": "col_share", "regLambda": "reg_lambda",
                 "minHessian": "min_hessian", "minRows": "min_rows"}
        return BO.BoostParams(**{**base, **{names[k]: v for k, v in params.items()}})
    return build


def _mlp(hidden, epochs):
    def build(params, seed, n, d):
        _known(params, "maxIter")
        return MultilayerPerceptronClassifier(featuresCol="__scaled", labelCol="label", seed=seed,
                                              layers=[d, *hidden, 2], maxIter=params.get("maxIter", epochs),
                                              blockSize=32, probabilityCol="__proba")
    return build


# fixed values: the shipped presets (single-valued grids)
REGISTRY = {
    "LR": ModelPreset("LR", "onehot", [{"C": 1.0, "penalty": "l1"}], _lr,
                      notes="L1 logistic regression, C=1, 500 iterations"),
    "RF": ModelPreset("RF", "onehot", [{"numTrees": 50, "maxDepth": 5}], _rf,
                      notes="50 trees, depth 5, sqrt features"),
    "XGB": ModelPreset("XGB", "bins", [{"maxIter": 10, "maxDepth": 5, "stepSize": 0.01}],
                       _boost(rounds=10, rate=0.01, row_share=0.5, col_share=0.5, min_hessian=1.0),
                       notes="boosted trees: 10 rounds, rate .01, rows .5, columns .5", extra={"early_stopping": 10}),
    "LGBM": ModelPreset("LGBM", "bins", [{"maxIter": 50, "maxDepth": 5, "stepSize": 0.01}],
                        _boost(rounds=50, rate=0.01, col_share=0.5, max_leaves=10, min_hessian=1e-3, min_rows=20),
                        notes="boosted trees, best first: 50 rounds, rate .01, 10 leaves, columns .5",
                        extra={"early_stopping": 10}),
    "ANN": ModelPreset("ANN", "onehot", [{"maxIter": 50}], _mlp((64,), 50), scale=True,
                       notes="feed-forward network, 64 hidden units", extra={"patience": 3}),
    "RNN": ModelPreset("RNN", "onehot", [{"maxIter": 30}], _mlp((32, 16), 30), scale=True,
                       notes="one-step recurrent net = feed-forward 32-16", extra={"patience": 3}),
}
# Spark ML's own boosted trees with the presets' round counts: depth-wise, no leaf cap, no missing values.
SPARK_TREES = {
    "GBT_A": ModelPreset("GBT_A", "index", [{"maxIter": 10, "maxDepth": 5, "stepSize": 0.01}], _gbt(10, 0.01, 0.5),
                         extra={"early_stopping": 10}),
    "GBT_B": ModelPreset("GBT_B", "index", [{"maxIter": 50, "maxDepth": 5, "stepSize": 0.01}], _gbt(50, 0.01, 1.0),
                         extra={"early_stopping": 10}),
}


def get_preset(name: str) -> ModelPreset:
    known = {**REGISTRY, **SPARK_TREES}
    if name not in known:
        raise ValueError(f"model {name!r} is not one of {list(known)}")
    return known[name]


def vector_names(df: DataFrame, col: str = FEATURES) -> list:
    """Names of the slots of an assembled vector, from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for kind in ("numeric", "binary", "nominal"):
        attrs += meta.get("attrs", {}).get(kind, [])
    names = {a["idx"]: a.get("name", f"f{a['idx']}") for a in attrs}
    n = meta.get("num_attrs", len(names))
    return [names.get(i, f"f{i}") for i in range(n)]


@dataclass
class FittedModel:
    name: str
    prep: object                  # fitted feature PipelineModel
    model: object                 # fitted classifier
    params: dict
    grid_log: list
    feature_names: list
    n_train: int
    n_trees: int | None = None    # boosted models cut at the best validation prefix

    def score(self, df: DataFrame, keys) -> DataFrame:
        """(keys..., split, model, label, prob) for the given rows."""
        if isinstance(self.model, BO.Boosted):
            tab = BO.binned(df, self.model.bins, [*keys, "split", "label"])
            return BO.scores(tab, {self.name: (self.model, self.n_trees)}, [*keys, "split", "label"]) \
                .select(*keys, "split", "model", "label", "prob")
        return self.score_encoded(self.prep.transform(df), keys)

    def score_encoded(self, enc: DataFrame, keys) -> DataFrame:
        """The same for rows that the feature pipeline has been through."""
        if self.n_trees is not None:
            out = prefix_margins(self.model, enc, self.n_trees)
            prob = 1.0 / (1.0 + F.exp(-2.0 * F.element_at("__margins", -1)))
        else:
            out = self.model.transform(enc)
            prob = vector_to_array(F.col("__proba"))[1]
        return out.select(*keys, "split", F.lit(self.name).alias("model"), "label", prob.alias("prob"))


def prefix_margins(model, df: DataFrame, last: int) -> DataFrame:
    """Add ``__margins``: array whose element p is the boosted margin of the
    first p trees (p = 1..last).

    Each tree scores the rows with its own ``transform`` (a JVM projection);
    the weighted outputs go into one array, read once, and prefix sums are a
    higher-order expression, so the plan grows linearly with the tree count.
    Probability is 1 / (1 + exp(-2 m)), the ensemble's own link."""
    trees, weights = model.trees, model.treeWeights
    out = df
    for i in range(last):
        t = trees[i].copy()
        t.setFeaturesCol(FEATURES).setPredictionCol(f"__t{i}")
        out = t.transform(out)
    terms = F.array(*[F.col(f"__t{i}") * float(weights[i]) for i in range(last)])
    sums = F.transform(terms, lambda x, i: F.aggregate(F.slice(terms, 1, i + 1), F.lit(0.0),
                                                       lambda a, y: a + y))
    return out.withColumn("__margins", sums).drop(*[f"__t{i}" for i in range(last)])


def early_stopping_cut(model, valid: DataFrame, patience: int) -> tuple[int, float]:
    """Best number of trees by validation AUC: AUC of every prefix in one job,
    then the booster's rule: keep going while a new best appears within
    ``patience`` rounds; the first maximum wins."""
    n = len(model.trees)
    # Written first: the AUC reads its input in several branches, and each would plan the chain of trees anew.
    ensure_checkpoint_dir(valid.sparkSession)
    wide = prefix_margins(model, valid.select("label", FEATURES), n).select("label", "__margins").checkpoint(eager=True)
    long = wide.select("label", F.posexplode("__margins").alias("pos", "score")) \
        .select("label", (F.col("pos") + 1).alias("prefix"), "score")
    aucs = {r["prefix"]: r["auc"] for r in
            ME.roc_auc(long, keys=["prefix"], score="score").collect()}
    return first_best(aucs, patience)


def first_best(aucs: dict, patience: int) -> tuple[int, float]:
    """The booster's rule over AUCs by number of trees: go on while a new best comes within ``patience`` rounds."""
    best_p, best = 1, aucs[1]
    for p in range(2, max(aucs) + 1):
        if p - best_p > patience:
            break
        if aucs[p] > best:
            best_p, best = p, aucs[p]
    return best_p, best


def prep_pipeline(preset: ModelPreset, numeric, categorical) -> Pipeline:
    stages = assemble_stages(numeric, categorical, preset.encoding, FEATURES)
    if preset.scale:
        stages.append(StandardScaler(inputCol=FEATURES, outputCol="__scaled", withMean=True, withStd=True))
    return Pipeline(stages=stages)


def in_threads(fn, items, parallel: int = PARALLEL_FITS) -> list:
    """``fn`` of every item in order, as concurrent jobs of this session."""
    items = list(items)
    if len(items) < 2 or parallel < 2:
        return [fn(x) for x in items]
    session = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()     # none is active in a thread of a pool
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(inheritable_thread_target(session)(fn), items))


def fit_model(name: str, data: DataFrame, numeric, categorical, keys, seed: int = P.SPLIT_SEED,
              grid: list | None = None) -> FittedModel:
    """Fit every grid entry on ``train``, score by AUC on ``validation``, keep
    the first best (earliest grid entry wins ties). The encoded table is
    written once and all entries are fitted on it, as concurrent jobs (boosted
    presets: all entries in one pass). Only the logistic grid skips entries,
    and only those whose parameters Spark rejects; they stay in the log with
    their error. All failing raises."""
    preset = get_preset(name)
    if preset.encoding == "bins":
        request = BoostRequest(name, name, list(numeric), list(categorical), grid, seed)
        return fit_boosted_models(data, [request], keys)[0][name]
    prep = prep_pipeline(preset, numeric, categorical).fit(data)
    enc = prep.transform(data)
    names = vector_names(enc)
    ensure_checkpoint_dir(data.sparkSession)
    used = [FEATURES, *(["__scaled"] if preset.scale else [])]
    return search_grid(name, prep, enc.select("split", "label", *used).checkpoint(eager=True), names, seed, grid)


def search_grid(name: str, prep, enc: DataFrame, names: list, seed: int = P.SPLIT_SEED,
                grid: list | None = None, n_train: int | None = None, score_single: bool = True) -> FittedModel:
    """The grid search over an encoded, written table.

    Without ``score_single`` a grid of one entry, which there is nothing to choose from, isn't scored here: its
    AUC in the log is None until the caller, who scores many models in one job, sets it."""
    preset = get_preset(name)
    grid = grid or preset.grid
    train, valid = (enc.filter(F.col("split") == s) for s in ("train", "validation"))
    n_train = train.count() if n_train is None else n_train

    def one(params):
        try:
            estimator = preset.build(params, seed, n_train, len(names))
            if preset.extra.get("patience"):
                model, rounds = fit_network(estimator, train, valid, preset.extra["patience"])
            else:
                model, rounds = estimator.fit(train), None
        except (IllegalArgumentException, TypeError, ValueError) as exc:
            if name != "LR":
                raise
            return {**params, "AUC": None, "error": str(exc)}, None, None, params
        cut = None
        if preset.extra.get("early_stopping"):
            cut, auc = early_stopping_cut(model, valid, preset.extra["early_stopping"])
        elif len(grid) == 1 and not score_single:
            auc = None
        else:
            scored = model.transform(valid).select(
                "label", vector_to_array(F.col("__proba"))[1].alias("prob"), F.lit(name).alias("model"),
                F.lit("validation").alias("split"))
            auc = ME.roc_auc(scored).first()["auc"]
        stop = {**({"best_iteration": cut} if cut else {}), **({"iterations": rounds} if rounds else {})}
        return {**params, "AUC": auc, **stop}, model, cut, {**params, **stop}
    found = in_threads(one, grid)
    log = [f[0] for f in found]
    fit = [f for f in found if f[1] is not None]
    if not fit:
        first = next((e.get("error") for e in log if e.get("error")), "")
        raise RuntimeError(f"no entry of the {name} grid could be fitted; the first failed with: {first}")
    entry, model, cut, params = max(fit, key=lambda f: f[0]["AUC"])      # the first of equals
    return FittedModel(name, prep, model, params, log, names, n_train, cut)


def fit_network(estimator, train: DataFrame, valid: DataFrame, patience: int, step: int = NETWORK_STEP) -> tuple:
    """Train in warm-started rounds of ``step`` iterations until the validation loss has not fallen for ``patience``
    rounds; returns the best round's model and its iterations."""
    whole, best, weights = estimator.getMaxIter(), None, None
    for done in range(step, whole + step, step):
        part = estimator.copy().setMaxIter(min(step, whole - done + step))
        if weights is not None:
            part.setInitialWeights(weights)
        model = part.fit(train)
        weights = model.weights
        p = vector_to_array(F.col("__proba"))[1]
        right = F.when(F.col("label") == 1, p).otherwise(1 - p)
        loss = model.transform(valid).agg(F.avg(-F.log(F.greatest(right, F.lit(1e-7)))).alias("l")).first()["l"]
        if best is None or loss < best[0]:
            best = (loss, model, min(done, whole), done)
        elif done - best[3] >= patience * step:
            break
    return best[1], best[2]


@dataclass
class NetworkRequest:
    """A network preset of one grid entry to fit under ``key`` on some slots of packed rows."""
    key: object
    preset: str
    slots: list
    prep: object
    names: list
    seed: int = P.SPLIT_SEED


def fit_network_models(spark: SparkSession, packed, width: int, requests: list, n_train: int) -> dict:
    """All requests, trained together: key -> FittedModel (its AUC in the log is None, see ``search_grid``).

    ``packed`` makes the packed rows of a block size."""
    estimators = [get_preset(r.preset).build(get_preset(r.preset).grid[0], r.seed, n_train, len(r.slots)) for r in requests]
    blocks = {e.getBlockSize() for e in estimators}
    if len(blocks) > 1:
        raise ValueError(f"networks that train together need one block size, not {sorted(blocks)}")
    starts = {(*e.getLayers(), e.getSeed()): e for e in estimators}
    starts = {k: network_of(spark, e).weights.toArray() for k, e in starts.items()}
    jobs = [NE.NetworkJob(r.slots, e.getLayers(), starts[*e.getLayers(), e.getSeed()], e.getMaxIter(),
                          get_preset(r.preset).extra["patience"], NETWORK_STEP, e.getTol())
            for r, e in zip(requests, estimators)]
    found = {}
    for r, e, (weights, steps) in zip(requests, estimators, NE.fit_networks(packed(blocks.pop()), width, jobs)):
        params = get_preset(r.preset).grid[0]
        found[r.key] = FittedModel(r.preset, r.prep, network_of(spark, e, weights), {**params, "iterations": steps},
                                   [{**params, "AUC": None, "iterations": steps}], r.names, n_train)
    return found


def network_of(spark: SparkSession, estimator, weights=None):
    """Spark's model with these weights (None: those that it starts from): a fit of no steps on a made-up row."""
    still = estimator.copy().setMaxIter(0)
    if weights is not None:
        still.setInitialWeights(Vectors.dense(weights))
    row = (0, Vectors.dense([0.0] * estimator.getLayers()[0]))
    return still.fit(spark.createDataFrame([row], [estimator.getLabelCol(), estimator.getFeaturesCol()]).coalesce(1))


@dataclass
class BoostRequest:
    """A boosted preset to fit under ``key`` on some columns of a table."""
    key: str
    preset: str
    numeric: list
    categorical: list
    grid: list | None = None
    seed: int = P.SPLIT_SEED


def fit_boosted_models(data: DataFrame, requests: list, keys) -> tuple:
    """All requests, with all their grid entries, in one pass a tree level over one binned, written table.

    Returns key -> FittedModel; key -> (model over the binned table, trees used); the binned table."""
    keys = list(keys)
    numeric = list(dict.fromkeys(c for r in requests for c in r.numeric))
    categorical = list(dict.fromkeys(c for r in requests for c in r.categorical))
    bins = BO.find_bins(data.filter("split = 'train'"), numeric, categorical)
    place = {b.name: i for i, b in enumerate(bins)}
    ensure_checkpoint_dir(data.sparkSession)
    table = BO.binned(data, bins, [*keys, "split", "label"]).checkpoint(eager=True)
    train, valid = (table.filter(F.col("split") == s) for s in ("train", "validation"))
    n_train, jobs, owner = train.count(), [], []
    for r in requests:
        preset = get_preset(r.preset)
        for params in r.grid or preset.grid:
            used = [place[c] for c in [*r.numeric, *r.categorical]]
            jobs.append(BO.Job(preset.build(params, r.seed, n_train, len(used)), used, r.seed))
            owner.append((r, params))
    models = BO.fit_boosted(train, bins, jobs, keys)
    looked = BO.prefix_scores(valid, {str(i): m for i, m in enumerate(models)}).checkpoint(eager=True)
    aucs: dict[int, dict] = {}
    for row in ME.roc_auc(looked, keys=["model", "prefix"], score="score").collect():       # a row a tree
        aucs.setdefault(int(row["model"]), {})[row["prefix"]] = row["auc"]
    fitted, wide = {}, {}
    for r in requests:
        best, log = None, []
        for i, (other, params) in enumerate(owner):
            if other is not r:
                continue
            cut, auc = first_best(aucs[i], get_preset(r.preset).extra["early_stopping"])
            log.append({**params, "AUC": auc, "best_iteration": cut})
            if best is None or auc > best[0]:
                best = (auc, models[i], params, cut)
        _, model, params, cut = best
        own = model.trimmed()
        fitted[r.key] = FittedModel(r.preset, None, own, {**params, "best_iteration": cut}, log, own.names, n_train, cut)
        wide[r.key] = (model, cut)
    return fitted, wide, table


def grid_log_frame(spark, fitted: FittedModel) -> DataFrame:
    """Grid-search log, best AUC first; entries that failed have their error."""
    rows = [(fitted.name, str({k: v for k, v in e.items() if k not in ("AUC", "error")}), e["AUC"], e.get("error"))
            for e in fitted.grid_log]
    return spark.createDataFrame(rows, "model string, params string, auc double, error string").orderBy(F.desc("auc"))


def importance(fitted: FittedModel, data: DataFrame, encoded: DataFrame | None = None) -> dict:
    """LR: coefficient and a descriptive p-value per encoded feature; trees:
    normalised split-gain importance; networks: none. ``encoded``: ``data`` after the feature pipeline, if at hand."""
    m = fitted.model
    if isinstance(m, BO.Boosted):
        return {n: [v] for n, v in m.importance().items()}
    if fitted.name == "LR":
        return coefficient_table(fitted, data, encoded)
    if hasattr(m, "featureImportances"):
        imp = m.featureImportances.toArray()
        return {n: [float(v)] for n, v in zip(fitted.feature_names, imp)}
    return {}


def coefficient_table(fitted: FittedModel, data: DataFrame, encoded: DataFrame | None = None) -> dict:
    """Coefficient and p-value with SE = sqrt(var/n + mean^2) (population
    variance of the encoded training column); p is the two-sided normal tail
    of coef / SE. Null p where the variance is 0. Not a Wald test: it is the
    study's descriptive statistic."""
    enc = (fitted.prep.transform(data) if encoded is None else encoded).filter(F.col("split") == "train")
    s = enc.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(FEATURES)).alias("s")).first().s
    n = s["count"]
    means, variances = s["mean"].toArray(), s["variance"].toArray()
    coef = fitted.model.coefficients.toArray()
    out = {}
    for name, c, mu, v in zip(fitted.feature_names, coef, means, variances):
        vp = v * (n - 1) / n if n > 1 else 0.0
        if vp > 0:
            se = math.sqrt(vp / n + mu * mu)
            z = c / se
            p = math.erfc(abs(z) / math.sqrt(2.0))
        else:
            p = None
        out[name] = [float(c), p]
    return out


def save_model(fitted: FittedModel, path: str) -> None:
    """Spark ML persistence for the feature pipeline and the classifier, and what scoring needs besides."""
    spark = _session(fitted)
    if isinstance(fitted.model, BO.Boosted):
        spark.createDataFrame([(fitted.model.to_json(),)], "value string").write.mode("overwrite").text(f"{path}/model")
    else:
        fitted.prep.write().overwrite().save(f"{path}/prep")
        fitted.model.write().overwrite().save(f"{path}/model")
    rest = {k: getattr(fitted, k) for k in ("name", "params", "grid_log", "feature_names", "n_train", "n_trees")}
    rest["class"] = type(fitted.model).__name__
    spark.createDataFrame([(json.dumps(rest),)], "value string").write.mode("overwrite").text(f"{path}/rest")


def load_model(spark, path: str) -> FittedModel:
    """A saved model; it scores as the one that was saved, early-stopping cut included."""
    rest = json.loads(spark.read.text(f"{path}/rest").first()["value"])
    kind = rest.pop("class")
    if kind == "Boosted":
        return FittedModel(prep=None, model=BO.Boosted.from_json(spark.read.text(f"{path}/model").first()["value"]), **rest)
    model = getattr(classification, kind).load(f"{path}/model")
    return FittedModel(prep=PipelineModel.load(f"{path}/prep"), model=model, **rest)


def tree_table(fitted: FittedModel, path: str | None = None) -> DataFrame:
    """Node table of a tree ensemble, read back from the model's own saved data:
    (tree_id, node_id, feature, threshold, categories, yes, no, missing, gain,
    cover, leaf). Boosted presets: ``cover`` is the sum of hessians, ``missing`` the
    default direction, categories are the levels that go left. Spark's own trees:
    ``cover`` is the training-row count, ``missing`` null (they have no default
    direction), categories are indices."""
    if isinstance(fitted.model, BO.Boosted):
        return BO.node_table(_session(fitted), fitted.model)
    if path is None:
        base = ensure_checkpoint_dir(_session(fitted))
        path = f"{base}/trees-{uuid.uuid4().hex}"
    fitted.model.write().overwrite().save(path)
    sess = _session(fitted)
    raw = sess.read.parquet(f"{path}/data")
    if "treeID" not in raw.columns:
        raw = raw.withColumn("treeID", F.lit(0))
    names = F.array(*[F.lit(n) for n in fitted.feature_names]) if fitted.feature_names else F.array()
    nd = F.col("nodeData")
    split = nd["split"]
    is_leaf = nd["leftChild"] < 0
    n_cats = split["numCategories"]
    return raw.select(
        F.col("treeID").cast("int").alias("tree_id"),
        nd["id"].cast("int").alias("node_id"),
        F.when(~is_leaf, F.element_at(names, split["featureIndex"] + 1)).alias("feature"),
        F.when(~is_leaf & (n_cats < 0), F.element_at(split["leftCategoriesOrThreshold"], 1)).alias("threshold"),
        F.when(~is_leaf & (n_cats >= 0),
               F.transform(split["leftCategoriesOrThreshold"], lambda x: x.cast("int"))).alias("categories"),
        F.when(~is_leaf, nd["leftChild"]).cast("int").alias("yes"),
        F.when(~is_leaf, nd["rightChild"]).cast("int").alias("no"),
        F.lit(None).cast("int").alias("missing"),
        F.when(~is_leaf, nd["gain"]).cast("double").alias("gain"),
        nd["rawCount"].cast("double").alias("cover"),
        F.when(is_leaf, nd["prediction"]).cast("double").alias("leaf"))


def _session(fitted: FittedModel):
    return SparkSession.getActiveSession()


def split_importance(nodes: DataFrame) -> DataFrame:
    """Per feature: number of splits and mean gain over a node table."""
    return (nodes.filter(F.col("feature").isNotNull())
            .groupBy("feature").agg(F.count(F.lit(1)).alias("splits"), F.avg("gain").alias("mean_gain")))
