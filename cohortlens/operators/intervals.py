"""Interval examples: one row per (participant, outcome, visit k) holding the
level at k, the change to k+1 and the outcome label.

Both outcomes come out of a single scan: each participant row explodes into
its (outcome, visit) pairs with ``explode`` over arrays, so the whole builder
is narrow (no shuffle) and grows linearly with the panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import presets as P
from ..functions import sqlexpr as X
from ..spec import STUDY, PanelSpec

OUTCOMES = ("drug", "diag")
_EXCLUDED = {"diag": P.DIAG_EXCLUDED_STATUS, "drug": P.DRUG_EXCLUDED_STATUS}


def outcome_source(df: DataFrame, outcome: str, spec: PanelSpec = STUDY) -> DataFrame:
    """Participants eligible for one outcome (status 1.1 leaves diag, 1.2 leaves drug)."""
    if outcome not in _EXCLUDED:
        raise ValueError("an outcome is diag or drug")
    status = spec.status_columns[1]
    return df.filter(F.col(status) != _EXCLUDED[outcome])


def build_intervals(df: DataFrame, spec: PanelSpec = STUDY, outcomes=OUTCOMES,
                    tag_col: str = "data_type") -> DataFrame:
    """Carried-forward panel -> interval examples for the given outcomes.

    Output: id, ``visit``, ``label``, baseline columns, ``age``, one level and
    one ``{f}_diff`` per feature, and ``tag_col``. Numeric changes are plain
    differences (sentinel arithmetic included); nominal changes are
    transition codes. A plan that needs visit k+1 beyond ``n_visits`` raises.
    The projections are SQL text (``selectExpr``), so planning stays fast for
    wide panels.
    """
    for o in outcomes:
        if o not in _EXCLUDED:
            raise ValueError("an outcome is diag or drug")
    dm, status = spec.status_columns
    plans = []
    for o in outcomes:
        n, pos = X.interval_plan(X.q(dm), X.q(status), o, _EXCLUDED[o])
        plans.append(f"named_struct('tag', '{o}', 'n', {n}, 'pos', {pos})")
    arrays = [f"array({', '.join(X.q(spec.feature_col(k, f)) for k in spec.visits())}) AS `__a_{f}`"
              for f in spec.features]
    arrays.append(f"array({', '.join(X.q(spec.age_col(k)) for k in spec.visits())}) AS `__a___age`")
    packed = df.selectExpr(X.q(spec.id_col), *[X.q(c) for c in spec.base_columns], *arrays,
                           f"explode(array({', '.join(plans)})) AS __o")
    guard = (f"CASE WHEN __o.n >= {spec.n_visits} THEN raise_error(concat('an interval of a "
             f"participant needs visit ', CAST(__o.n + 1 AS STRING), ' but n_visits={spec.n_visits}')) "
             f"ELSE __o.n > 0 END")
    rows = packed.filter(F.expr(guard)).selectExpr("*", "explode(sequence(1, __o.n)) AS visit")
    out = [X.q(spec.id_col), "CAST(visit AS INT) AS visit",
           "coalesce(CAST(visit = __o.pos AS INT), 0) AS label",
           *[X.q(c) for c in spec.base_columns], "element_at(`__a___age`, visit) AS age"]
    diffs = []
    for f in spec.features:
        cur, nxt = f"element_at(`__a_{f}`, visit)", f"element_at(`__a_{f}`, visit + 1)"
        out.append(f"{cur} AS {X.q(f)}")
        lv = spec.n_levels(f)
        d = f"{nxt} - {cur}" if lv is None else X.transition_code(cur, nxt, lv, spec.sentinel)
        diffs.append(f"{d} AS `{f}_diff`")
    return rows.selectExpr(*out, *diffs, f"__o.tag AS {X.q(tag_col)}")


def build_intervals_long(long_df: DataFrame, people: DataFrame, spec: PanelSpec = STUDY, outcomes=OUTCOMES,
                         tag_col: str = "data_type") -> DataFrame:
    """The same interval examples from a long panel: (id, feature, visit, value), carried forward, ``age`` a feature.

    The next visit's value comes by ``lead`` over (id, feature), a window of
    ``n_visits`` rows, so no participant is gathered as a whole before the
    last grouping. ``people`` has a row per participant with the status and
    baseline columns.
    """
    for o in outcomes:
        if o not in _EXCLUDED:
            raise ValueError("an outcome is diag or drug")
    dm, status = spec.status_columns
    plans = []
    for o in outcomes:
        n, pos = X.interval_plan(X.q(dm), X.q(status), o, _EXCLUDED[o])
        plans.append(f"named_struct('tag', '{o}', 'n', {n}, 'pos', {pos})")
    wanted = people.selectExpr(X.q(spec.id_col), *[X.q(c) for c in spec.base_columns], f"explode(array({', '.join(plans)})) AS __o") \
        .filter("__o.n > 0").selectExpr("*", "explode(sequence(1, __o.n)) AS visit")
    nxt = F.lead("value").over(Window.partitionBy(spec.id_col, "feature").orderBy("visit"))
    steps = long_df.withColumn("__next", nxt)
    kinds = {f: spec.n_levels(f) for f in spec.features}
    change = "__next - value"
    for levels in sorted({n for n in kinds.values() if n is not None}):
        names = ", ".join(f"'{f}'" for f, n in kinds.items() if n == levels)
        change = f"CASE WHEN feature IN ({names}) THEN {X.transition_code('value', '__next', levels, spec.sentinel)} ELSE {change} END"
    steps = steps.selectExpr(X.q(spec.id_col), "feature", "CAST(visit AS INT) AS visit", "value", f"{change} AS __change")
    cells = []
    for f in spec.features:
        cells += [F.max(F.when(F.col("feature") == f, F.col("value"))).alias(f),
                  F.max(F.when(F.col("feature") == f, F.col("__change"))).alias(f"{f}_diff")]
    age = F.max(F.when(F.col("feature") == "age", F.col("value"))).alias("age")
    rows = steps.groupBy(spec.id_col, "visit").agg(age, *cells).join(
        wanted.withColumn("visit", F.col("visit").cast("int")), [spec.id_col, "visit"])
    return rows.select(spec.id_col, "visit", F.expr("coalesce(CAST(visit = __o.pos AS INT), 0)").alias("label"),
                       *spec.base_columns, "age", *spec.features, *[f"{f}_diff" for f in spec.features],
                       F.col("__o.tag").alias(tag_col))


def drop_missing_baseline(df: DataFrame, spec: PanelSpec = STUDY, outcome: str = "drug",
                          tag_col: str = "data_type") -> DataFrame:
    """Drop rows of one outcome whose listed baseline columns hold the sentinel."""
    bad = None
    for c in spec.drug_drop_columns:
        cond = F.col(c) == spec.sentinel
        bad = cond if bad is None else (bad | cond)
    if bad is None:
        return df
    return df.filter(~F.coalesce((F.col(tag_col) == outcome) & bad, F.lit(False)))


def transition_table(df: DataFrame, spec: PanelSpec = STUDY) -> DataFrame:
    """Nominal transition codes for every adjacent visit pair (k -> k+1) of a
    carried-forward panel: one row per (participant, k), one ``{f}_code`` per
    nominal feature. Narrow: an explode over ``n_visits - 1`` positions."""
    arrays = [f"array({', '.join(X.q(spec.feature_col(k, f)) for k in spec.visits())}) AS `__a_{f}`"
              for f in spec.nominal]
    packed = df.selectExpr(X.q(spec.id_col), *arrays, f"explode(sequence(1, {spec.n_visits - 1})) AS visit")
    codes = [X.transition_code(f"element_at(`__a_{f}`, visit)", f"element_at(`__a_{f}`, visit + 1)",
                               spec.n_levels(f), spec.sentinel) + f" AS `{f}_code`" for f in spec.nominal]
    return packed.selectExpr(X.q(spec.id_col), "CAST(visit AS INT) AS visit", *codes)
