"""Entry 2: feature set x PCA mode x model sweep with an averaging ensemble.

What all combinations share is made once: the participant split (it depends
on ids and labels), the oversampling, the principal components of every block
(from one correlation matrix), the category strings and their encodings. They
form one wide table, cut to the shared checkpoint folder; a combination is a
choice of its columns. The boosted models of all combinations are fitted in
one pass a tree level, the networks of all combinations in one pass a loss and
gradient; the others as concurrent jobs. All predictions form one long table,
so AUC, cutoffs and ensembles of the whole sweep are a few jobs. Only metrics, parameters and importances reach the driver; the result
is a metrics DataFrame.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import presets as P
from ..operators import boosting as BO
from ..operators import features as FE
from ..operators import metrics as ME
from ..operators import models as MO
from ..operators import networks as NE
from ..operators import split as SP
from ..session import ensure_checkpoint_dir

METRICS_SCHEMA = T.StructType([
    T.StructField("feature_set", T.StringType()),
    T.StructField("pca_mode", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("auc_validation", T.DoubleType()),
    T.StructField("auc_test", T.DoubleType()),
    T.StructField("cutoff", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("importance", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    T.StructField("position", T.IntegerType()),       # place in the sweep
])


@dataclass
class ExperimentConfig:
    feature_sets: tuple = P.FEATURE_SETS
    pca_modes: tuple = P.PCA_MODES
    models: tuple = P.MODEL_NAMES
    sampling: str | None = None
    seed: int = P.SPLIT_SEED
    blocks: dict = field(default_factory=lambda: dict(P.FEATURE_BLOCKS))
    set_drops: dict = field(default_factory=lambda: dict(P.FEATURE_SET_DROPS))
    set_pca_blocks: dict = field(default_factory=lambda: dict(P.FEATURE_SET_PCA_BLOCKS))
    categorical: tuple = ()
    row_keys: tuple = (P.ID_COL, "visit")
    targets: dict | None = None
    pca_groups: dict = field(default_factory=dict)
    pca_train_only: bool = False        # fit PCA on the training split instead of the whole table
    on_unreached: str = "cap"           # components kept where the variance is not reached
    shrink: bool = False                # allow oversampling targets below the positives present
    output: str | None = None           # folder of the sweep's files, written if set
    ensemble: bool = True
    parallel_combos: int = 8            # fits that run at a time


def prepare_combo(df: DataFrame, feature_set: str, pca_mode: str, cfg: ExperimentConfig) -> DataFrame:
    """Feature selection -> split -> PCA (fitted on the whole table, or on train) -> strings; written once."""
    sel = FE.feature_selection(df, feature_set, cfg.blocks, cfg.set_drops)
    rows = SP.data_split(sel, None, cfg.seed)
    fit_on = rows.filter("split = 'train'") if cfg.pca_train_only else sel
    rows = FE.pca_features(rows, pca_mode, feature_set, cfg.blocks, cfg.set_pca_blocks, fit_on=fit_on,
                           groups=cfg.pca_groups, on_unreached=cfg.on_unreached)
    rows = _sampled(rows, cfg)
    rows = FE.nominal_strings(rows, cfg.categorical)
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint(eager=True)


def combo_predictions(rows: DataFrame, cfg: ExperimentConfig) -> tuple[DataFrame, dict]:
    """Fit every model on one prepared combination; long predictions + fitted models."""
    keys = [*cfg.row_keys, "copy"]
    cat = FE.existing(rows, cfg.categorical)
    numeric = [c for c in FE.feature_columns(rows, FE.ID_LIKE + tuple(keys)) if c not in cat]
    hold = rows.filter(F.col("split").isin("validation", "test"))
    preds, fitted = None, {}
    for name in cfg.models:
        fm = MO.fit_model(name, rows, numeric, cat, keys, cfg.seed)
        fitted[name] = fm
        p = fm.score(hold, keys)
        preds = p if preds is None else preds.unionByName(p)
    preds = preds.checkpoint(eager=True)
    if cfg.ensemble and len(cfg.models) > 1:
        ens = ME.ensemble_mean(preds, list(cfg.models), (*keys, "split"))
        preds = preds.unionByName(ens.select(*preds.columns))
    return preds, fitted


def write_combo(preds: DataFrame, fitted: dict, path: str) -> None:
    """The files of one combination: per model its grid log, itself, its trees; ROC points of all models."""
    spark = preds.sparkSession
    for name, fm in fitted.items():
        MO.grid_log_frame(spark, fm).write.mode("overwrite").parquet(f"{path}/{name}/grid_log")
        MO.save_model(fm, f"{path}/{name}/fitted")
        if hasattr(fm.model, "trees"):
            MO.tree_table(fm).repartition("tree_id").write.mode("overwrite").partitionBy("tree_id").parquet(f"{path}/{name}/trees")
    ME.roc_points(preds).write.mode("overwrite").parquet(f"{path}/roc_points")


@dataclass
class Shared:
    """The wide table of a sweep and the columns that each combination takes of it."""
    rows: DataFrame                 # split, oversampled, with all components and category strings
    columns: dict                   # (feature set, PCA mode) -> (numeric, categorical)
    keys: list


def share(df: DataFrame, cfg: ExperimentConfig) -> Shared:
    """Split, oversample, fit every PCA block of the sweep and append the components, once."""
    blocks, members = {}, {}
    for fs in cfg.feature_sets:
        have = FE.feature_selection(df, fs, cfg.blocks, cfg.set_drops)
        if fs not in cfg.set_pca_blocks:
            raise ValueError(f"no PCA blocks are known for feature set {fs}")
        for name in cfg.set_pca_blocks[fs]:
            cols = FE.existing(have, FE.block_members(name, cfg.blocks, cfg.pca_groups))
            if cols:
                # Blocks go by name; one that means other columns in this set is a block of its own.
                own = name if blocks.get(name, cols) == cols else f"{fs}_{name}"
                blocks[own] = cols
                members.setdefault(fs, []).append((name, own, cols))
    rows = SP.data_split(df, None, cfg.seed)
    pca = FE.PCABlocks(blocks if set(cfg.pca_modes) - {"none"} else {}, on_unreached=cfg.on_unreached) \
        .fit(rows.filter("split = 'train'") if cfg.pca_train_only else df)
    rows = _sampled(pca.transform(rows) if pca.loadings else rows, cfg)
    rows = FE.nominal_strings(rows, cfg.categorical)
    ensure_checkpoint_dir(rows.sparkSession)
    keys, columns = [*cfg.row_keys, "copy"], {}
    components = {c for name in pca.loadings for c in pca.output_columns(name)}
    for fs in cfg.feature_sets:
        plain = [c for c in FE.feature_selection(rows, fs, cfg.blocks, cfg.set_drops).columns if c not in components]
        plain = [c for c in plain if c in FE.feature_columns(rows, FE.ID_LIKE + tuple(keys))]
        for mode in cfg.pca_modes:
            if mode not in ("none", "plus", "only"):
                raise ValueError(f"PCA mode {mode!r} is not one of none, plus, only")
            own = list(plain)
            if mode != "none":
                own += [c for _, block, _ in members.get(fs, ()) for c in pca.output_columns(block)]
            if mode == "only":
                gone = {c for _, _, cols in members.get(fs, ()) for c in cols}
                own = [c for c in own if c not in gone]
            cat = [c for c in own if c in set(cfg.categorical)]
            columns[fs, mode] = ([c for c in own if c not in cat], cat)
    return Shared(rows.checkpoint(eager=True), columns, keys)


def _sampled(rows: DataFrame, cfg: ExperimentConfig) -> DataFrame:
    if cfg.sampling != "over":
        return rows.withColumn("copy", F.lit(0).cast("long"))
    targets = cfg.targets
    if targets is None:
        n = rows.filter("split = 'train'").agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
        targets = {"train": max(n[0] or 0, n[1] or 0)}
    return SP.oversample_positive(rows, targets, list(cfg.row_keys), cfg.seed, shrink=cfg.shrink)


class Encoded:
    """Category encodings of the wide table, fitted and written once; combinations only assemble and scale."""

    def __init__(self, shared: Shared):
        self.shared = shared
        cats = list(dict.fromkeys(c for _, cat in shared.columns.values() for c in cat))
        self.cats, self.fitted = cats, {"onehot": [], "index": []}
        self.rows, sizes, self.scalers = shared.rows, [], {}
        if cats:
            model = Pipeline(stages=FE.one_hot_stages(cats)).fit(shared.rows)
            self.rows = model.transform(shared.rows).checkpoint(eager=True)
            self.fitted = {"onehot": list(model.stages), "index": list(model.stages[:1])}
            sizes = model.stages[1].categorySizes
        # The slots of the numeric columns and one-hot categories of all combinations, side by side.
        self.numeric = list(dict.fromkeys(c for num, _ in shared.columns.values() for c in num))
        self.slots, self.width = {}, 0
        for c, n in [*((c, 1) for c in self.numeric), *zip(cats, sizes)]:
            self.slots[c] = range(self.width, self.width + n)
            self.width += n

    def model_input(self, combo, encoding: str, scale: bool) -> tuple:
        """(pipeline of shared and own fitted stages, encoded rows) of one combination and encoding."""
        numeric, cat = self.shared.columns[combo]
        suffix = "__hot" if encoding == "onehot" else "__idx"
        stages = [VectorAssembler(inputCols=[*numeric, *[c + suffix for c in cat]], outputCol=MO.FEATURES, handleInvalid="keep")]
        enc = stages[0].transform(self.rows)
        if scale:
            if (combo, encoding) not in self.scalers:
                self.scalers[combo, encoding] = StandardScaler(inputCol=MO.FEATURES, outputCol="__scaled",
                                                               withMean=True, withStd=True).fit(enc)
            stages.append(self.scalers[combo, encoding])
            enc = stages[1].transform(enc)
        prep = PipelineModel(stages=[*(self.fitted[encoding] if cat else []), *stages])
        return prep, enc

    def own_slots(self, combo) -> list:
        """Where the slots of a combination's one-hot vector are among all."""
        return [i for cols in self.shared.columns[combo] for c in cols for i in self.slots[c]]

    def packed(self, combos, block: int) -> DataFrame:
        """The networks' inputs: all slots, scaled as in the combinations that use them."""
        shift, scale = [0.0] * self.width, [0.0] * self.width
        for combo in combos:
            fitted = self.scalers[combo, "onehot"]
            for i, mean, sd in zip(self.own_slots(combo), fitted.mean.toArray().tolist(), fitted.std.toArray().tolist()):
                shift[i], scale[i] = mean, 1.0 / sd if sd else 0.0
        wide = VectorAssembler(inputCols=[*self.numeric, *[c + "__hot" for c in self.cats]], outputCol="__wide", handleInvalid="keep")
        return NE.packed(wide.transform(self.rows), vector_to_array(F.col("__wide")), shift, scale, block)


def run_experiment(spark: SparkSession, df: DataFrame, cfg: ExperimentConfig) -> DataFrame:
    """All combinations. With ``cfg.output`` the sweep's files are written there."""
    for m in cfg.models:
        MO.get_preset(m)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sweep-{uuid.uuid4().hex}"
    shared = share(df.checkpoint(eager=True), cfg)
    combos = [(fs, pm) for fs in cfg.feature_sets for pm in cfg.pca_modes]
    keys, held = shared.keys, F.col("split").isin("validation", "test")
    where = ["feature_set", "pca_mode"]
    fitted: dict = {}
    importance: dict = {}

    def predicted(preds, combo):
        return preds.select(*[F.lit(v).alias(c) for c, v in zip(where, combo)], *keys, "split", "model", "label", "prob")

    boosted = [m for m in cfg.models if MO.get_preset(m).encoding == "bins"]
    others = [m for m in cfg.models if m not in boosted]
    networks = [m for m in others if MO.get_preset(m).extra.get("patience") and len(MO.get_preset(m).grid) == 1
                and MO.get_preset(m).scale and MO.get_preset(m).encoding == "onehot"]
    n_train = shared.rows.filter("split = 'train'").count()

    def fit_boosted():
        requests = [MO.BoostRequest((c, m), m, *shared.columns[c], None, cfg.seed) for c in combos for m in boosted]
        found, wide, table = MO.fit_boosted_models(shared.rows, requests, keys)
        fitted.update(found)
        names = {json.dumps([*c, m]): v for (c, m), v in wide.items()}
        long = BO.scores(table.filter(held), names, [*keys, "split", "label"])
        parts = F.from_json("model", "array<string>")
        long.select(*[parts[i].alias(c) for i, c in enumerate(where)], *keys, "split", parts[2].alias("model"), "label", "prob") \
            .write.parquet(f"{folder}/boosted")

    encoded = Encoded(shared) if others else None

    def write_scores(combo, name, model, enc):
        fitted[combo, name] = model
        predicted(model.score_encoded(enc.filter(held), keys), combo).write.parquet(
            f"{folder}/{combos.index(combo)}-{name}")

    def fit_networks():
        inputs = dict(zip(combos, MO.in_threads(lambda c: encoded.model_input(c, "onehot", True), combos)))
        requests = [MO.NetworkRequest((c, m), m, encoded.own_slots(c), inputs[c][0], MO.vector_names(inputs[c][1]), cfg.seed)
                    for c in combos for m in networks]
        found = MO.fit_network_models(spark, lambda block: encoded.packed(combos, block), encoded.width, requests, n_train)
        MO.in_threads(lambda r: write_scores(*r.key, found[r.key], inputs[r.key[0]][1]), requests)

    def fit_one(task):
        if callable(task):
            return task()
        combo, name = task
        preset = MO.get_preset(name)
        prep, enc = encoded.model_input(combo, preset.encoding, preset.scale)
        slots = MO.vector_names(enc)
        used = [MO.FEATURES, *(["__scaled"] if preset.scale else [])]
        model = MO.search_grid(name, prep, enc.select("split", "label", *used), slots, cfg.seed, n_train=n_train, score_single=False)
        write_scores(combo, name, model, enc)
        importance[combo, name] = MO.importance(model, shared.rows, enc)

    # The two long chains of jobs first.
    tasks = ([fit_boosted] if boosted else []) + ([fit_networks] if networks else []) \
        + [(c, m) for c in combos for m in others if m not in networks]
    MO.in_threads(fit_one, tasks, cfg.parallel_combos)
    for key, fm in fitted.items():
        if key not in importance:
            importance[key] = MO.importance(fm, shared.rows)
    paths = ([f"{folder}/boosted"] if boosted else []) + [f"{folder}/{combos.index(c)}-{m}" for c in combos for m in others]
    preds = spark.read.parquet(*paths)
    with_ensemble = cfg.ensemble and len(cfg.models) > 1
    if with_ensemble:
        ens = ME.ensemble_mean(preds, list(cfg.models), (*where, *keys, "split"))
        preds = preds.unionByName(ens.select(*preds.columns)).checkpoint(eager=True)
    # A row per combination, model and split at most.
    aucs = {(r["feature_set"], r["pca_mode"], r["model"], r["split"]): r["auc"]
            for r in ME.roc_auc(preds, keys=[*where, "model", "split"]).collect()}
    cuts = {(r["feature_set"], r["pca_mode"], r["model"]): r for r in ME.best_cutoff(preds, keys=[*where, "model"]).collect()}
    for (combo, name), fm in fitted.items():
        for entry in fm.grid_log:
            if entry["AUC"] is None and "error" not in entry:       # a grid of one entry: scored with all others
                entry["AUC"] = aucs.get((*combo, name, "validation"))
    rows = []
    for combo in combos:
        for name in [*cfg.models, *(["Ensemble"] if with_ensemble else [])]:
            if name == "Ensemble":
                params = {"method": "average of predicted probabilities", "models": json.dumps(list(cfg.models))}
                imp = {}
            else:
                params = {k: str(v) for k, v in fitted[combo, name].params.items()}
                imp = importance[combo, name]
            c = cuts[(*combo, name)]
            rows.append((*combo, name, aucs.get((*combo, name, "validation")), aucs.get((*combo, name, "test")), c["cutoff"],
                         c["precision"], c["recall"], c["f1"], c["accuracy"], params, imp, len(rows)))
    metrics = spark.createDataFrame(rows, METRICS_SCHEMA)
    if cfg.output:
        for combo in combos:
            own = preds.filter((F.col("feature_set") == combo[0]) & (F.col("pca_mode") == combo[1])).drop(*where)
            write_combo(own, {m: fitted[combo, m] for m in cfg.models}, f"{cfg.output}/{combo[0]}/{combo[1]}")
        write_metrics(metrics, cfg.output)
    return metrics


def auc_summary(metrics: DataFrame) -> DataFrame:
    """Flattened result, best test AUC first."""
    return metrics.orderBy(F.desc("auc_test"), "position") \
        .select("feature_set", "pca_mode", "model", "auc_validation", "auc_test")


def best_row(metrics: DataFrame) -> DataFrame:
    """The combination with the highest test AUC (first in sweep order on ties)."""
    top = metrics.agg(F.max_by(F.struct(*metrics.columns), F.struct("auc_test", -F.col("position"))).alias("r"))
    return top.select("r.*")


def metrics_json(metrics: DataFrame) -> DataFrame:
    """Nested result as JSON text: feature set -> PCA mode -> model -> metrics."""
    per_model = metrics.groupBy("feature_set", "pca_mode").agg(F.map_from_entries(F.collect_list(
        F.struct("model", F.struct("auc_validation", "auc_test", "cutoff", "precision", "recall", "f1",
                                   "accuracy", "params", "importance")))).alias("m"))
    per_set = per_model.groupBy("feature_set").agg(
        F.map_from_entries(F.collect_list(F.struct("pca_mode", "m"))).alias("p"))
    # one row per combination at most: the final fold is over the bounded metrics table
    return per_set.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("feature_set", "p"))))
                       .alias("json"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Sinks: ranking as CSV, nested result as JSON text."""
    auc_summary(metrics).write.mode("overwrite").option("header", True).csv(f"{path}/auc_summary")
    metrics_json(metrics).write.mode("overwrite").text(f"{path}/results_json")
