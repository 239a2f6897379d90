"""Independent SQL (DuckDB dialect) for the registered queries.

Each statement reads the driver's tables directly and restates the query's
semantics declaratively, so the Spark result can be checked against it.
The text is generated from the same stand-in spec so names line up.
"""

from __future__ import annotations

from .. import presets as P
from ..sources.standins import EVENT_SPEC, EVENT_TYPES, SEGMENT_CODES

S = "CAST(99999 AS DOUBLE)"
T = "90000"
SPEC = EVENT_SPEC
V = list(SPEC.visits())


def _fv(k, f):
    return f"v{k}_{f}"


def _cte(*parts):
    return "WITH " + ",\n".join(parts) + "\n"


# --- stand-in inputs --------------------------------------------------------

def _event_ctes(scale_income: bool = False):
    cell_max = ", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in EVENT_TYPES)
    feats = list(EVENT_TYPES) + ["income", "active", "tier"]
    wide_cols = ", ".join(f"max(CASE WHEN visit = {k} THEN {f} END) AS V{k}_{f.upper()}"
                          for k in V for f in feats)
    age_cols = ", ".join(f"max(CASE WHEN visit = {k} THEN age END) AS AS{k}_AGE" for k in V)
    out_cols = ", ".join([f"V{k}_{f.upper()}" for k in V for f in feats] + [f"AS{k}_AGE" for k in V])
    seg = " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in SEGMENT_CODES.items())
    ctes = [
        "ev AS (SELECT user_id, ts, event_type, value, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) "
        "AS k, CAST(floor(date_diff('day', DATE '2024-01-01', "
        "CAST(ts AS DATE)) / 3) AS INTEGER) + 1 AS visit FROM events)",
        f"cells0 AS (SELECT user_id, visit, {cell_max}, "
        "sum(CASE WHEN event_type = 'purchase' THEN value END) AS income, "
        "CAST(count(*) AS DOUBLE) AS age, arg_min(event_type, ts) AS ft, min(ts) AS fts, "
        "max(CAST(event_type = 'purchase' AND value > 120 AND k >= 50 AS INTEGER)) AS hit "
        "FROM ev GROUP BY user_id, visit)",
        "cells AS (SELECT *, CASE WHEN view IS NOT NULL THEN CAST(view > 30 AS DOUBLE) END AS active, "
        "CASE WHEN purchase IS NOT NULL THEN CAST(least(floor(purchase / 120), 2) AS DOUBLE) END AS tier "
        "FROM cells0)",
        f"wide AS (SELECT user_id, {wide_cols}, {age_cols}, "
        "min(CASE WHEN hit = 1 THEN visit END) AS ev_, max(visit) AS last_, "
        "arg_min(ft, fts) AS first_ FROM cells GROUP BY user_id)",
        "cohort0 AS (SELECT user_id AS RID, CAST(CASE WHEN ev_ IS NOT NULL THEN ev_ WHEN last_ < 10 "
        "THEN 20 - last_ ELSE 10 END AS DOUBLE) AS DMCASE, CASE WHEN first_ = 'error' THEN "
        "CAST(1.1 AS DOUBLE) WHEN first_ = 'signup' THEN CAST(1.2 AS DOUBLE) END AS DMSTATUS_SUB, "
        f"{out_cols} FROM wide)",
        "cust AS (SELECT c_custkey AS RID, CAST(c_nationkey AS VARCHAR) AS AS1_AREA, "
        f"CASE c_mktsegment {seg} ELSE '.' END AS AS1_EDUA, "
        "CASE WHEN c_acctbal < 5000 THEN '0' ELSE '1' END AS V1_FDM_REL, "
        "CASE WHEN c_acctbal < 0 THEN '.' ELSE CAST(CAST(floor(c_acctbal / 2500) AS BIGINT) AS VARCHAR) "
        "END AS V1_HOUSE, CASE WHEN c_nationkey % 2 = 0 THEN '1' ELSE '2' END AS AS1_SEX FROM customer)",
    ]
    meas_cols = ", ".join(f"CASE WHEN {c} = '.' THEN {S} ELSE TRY_CAST({c} AS DOUBLE) END AS {c}"
                          for c in ("AS1_AREA", "AS1_EDUA", "V1_FDM_REL", "V1_HOUSE", "AS1_SEX"))
    ctes.append(f"meas AS (SELECT RID, {meas_cols} FROM cust)")
    if scale_income:
        inc = {f"V{k}_INCOME" for k in V}
        cols = []
        for c in ["RID", "DMCASE", "DMSTATUS_SUB"] + out_cols.split(", "):
            if c in inc:
                x = f"TRY_CAST({c} AS DOUBLE)"
                cols.append(f"CASE WHEN {x} IS NOT NULL AND {x} != {S} THEN {x} / 10000 ELSE {x} END AS {c}")
            else:
                cols.append(c)
        ctes.append(f"cohort AS (SELECT {', '.join(cols)} FROM cohort0)")
    else:
        ctes.append("cohort AS (SELECT * FROM cohort0)")
    ctes.append("merged AS (SELECT c.*, m.* EXCLUDE (RID) FROM cohort c LEFT JOIN meas m "
                "ON c.RID IS NOT DISTINCT FROM m.RID)")
    return ctes


def _fill(x):
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {S} ELSE {x} END"


def _panel_ctes(scale_income: bool = False):
    ctes = _event_ctes(scale_income)
    dm, status = SPEC.status_columns
    cols = []
    for c in SPEC.required_columns():
        if c == SPEC.id_col:
            cols.append(f"RID AS {c}")
        elif c == status:
            cols.append(f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0) AS {c}")
        else:
            cols.append(f"{_fill(f'TRY_CAST({c} AS DOUBLE)')} AS {c}")
    ctes.append(f"prepared AS (SELECT {', '.join(cols)} FROM merged)")
    series = [[_fv(k, f) for k in V] for f in SPEC.features] + [[f"as{k}_age" for k in V]]
    carried = {}
    for cols_ in series:
        for k in range(1, len(cols_)):
            args = [f"nullif({c}, {S})" for c in reversed(cols_[1:k + 1])] + [cols_[0]]
            carried[cols_[k]] = f"coalesce({', '.join(args)})"
    sel = ", ".join(f"{carried[c]} AS {c}" if c in carried else c for c in SPEC.required_columns())
    ctes.append(f"carried AS (SELECT {sel} FROM prepared)")
    return ctes


def _code(a, b, n):
    ok = f"{a} > -1 AND {a} < {n} AND {b} > -1 AND {b} < {n}"
    return f"CASE WHEN {ok} THEN CAST(trunc({a}) * {n} + trunc({b}) + 1 AS DOUBLE) ELSE {S} END"


def _interval_ctes(outcome: str, name: str):
    lo, shift, excl = (1, 0, P.DIAG_EXCLUDED_STATUS) if outcome == "diag" else (2, 1, P.DRUG_EXCLUDED_STATUS)
    d = "CASE WHEN dmcase > -1 AND dmcase < 20 THEN CAST(trunc(dmcase) AS INTEGER) END"
    plan = (f"{name}_p AS (SELECT *, CASE WHEN dmstatus_sub = CAST({excl} AS DOUBLE) THEN 0 "
            f"WHEN d_ BETWEEN {lo} AND 9 THEN d_ - {shift} WHEN d_ = 10 THEN 9 WHEN d_ > 10 THEN 19 - d_ "
            f"ELSE 0 END AS n_, CASE WHEN d_ BETWEEN {lo} AND 9 THEN d_ - {shift} END AS pos_ "
            f"FROM (SELECT *, {d} AS d_ FROM carried))")
    ex = f"{name}_x AS (SELECT *, unnest(range(1, n_ + 1)) AS vv FROM {name}_p WHERE n_ > 0)"

    def at(cols, idx):
        return f"list_extract([{', '.join(cols)}], {idx})"

    sel = [SPEC.id_col, "CAST(vv AS INTEGER) AS visit",
           "COALESCE(CAST(vv = pos_ AS INTEGER), 0) AS label", *SPEC.base_columns,
           f"{at([f'as{k}_age' for k in V], 'vv')} AS age"]
    diffs = []
    for f in SPEC.features:
        cols = [_fv(k, f) for k in V]
        cur, nxt = at(cols, "vv"), at(cols, "vv + 1")
        sel.append(f"{cur} AS {f}")
        n = SPEC.n_levels(f)
        diffs.append(f"{nxt} - {cur} AS {f}_diff" if n is None else f"{_code(cur, nxt, n)} AS {f}_diff")
    body = f"{name} AS (SELECT {', '.join(sel + diffs)}, '{outcome}' AS data_type FROM {name}_x)"
    return [plan, ex, body]


def _interval_columns():
    return SPEC.interval_columns() + ["data_type"]


def _all_intervals_ctes(scale_income: bool):
    ctes = _panel_ctes(scale_income) + _interval_ctes("drug", "drug_iv") + _interval_ctes("diag", "diag_iv")
    bad = " OR ".join(f"{c} = {S}" for c in SPEC.drug_drop_columns)
    ctes.append(f"iv AS (SELECT * FROM drug_iv WHERE NOT ({bad}) UNION ALL SELECT * FROM diag_iv)")
    return ctes


def _null_ctes(scale_income: bool):
    ctes = _all_intervals_ctes(scale_income)
    sel = []
    for c in _interval_columns():
        if c in (SPEC.id_col, "data_type"):
            sel.append(c)
        else:
            sel.append(f"CASE WHEN {c} > {T} OR {c} < -{T} THEN NULL ELSE {c} END AS {c}")
    ctes.append(f"nul AS (SELECT {', '.join(sel)} FROM iv)")
    return ctes


def _categorical():
    return list(SPEC.categorical_columns)


def _mean_columns():
    skip = {SPEC.id_col, "label", "visit", "data_type"} | set(_categorical())
    return [c for c in _interval_columns() if c not in skip]


def _stats_ctes(scale_income: bool):
    ctes = _null_ctes(scale_income)
    cat = _categorical()
    ctes.append(f"cat_long AS (UNPIVOT (SELECT data_type, {', '.join(cat)} FROM nul) "
                f"ON {', '.join(cat)} INTO NAME col VALUE value)")
    ctes.append("mode_stats AS (SELECT data_type, col, value FROM (SELECT data_type, col, value, "
                "row_number() OVER (PARTITION BY data_type, col ORDER BY count(*) DESC, value ASC) AS rn "
                "FROM cat_long GROUP BY data_type, col, value) WHERE rn = 1)")
    num = _mean_columns()
    ctes.append(f"mean_wide AS (SELECT data_type, {', '.join(f'avg({c}) AS {c}' for c in num)} "
                "FROM nul GROUP BY data_type)")
    ctes.append(f"mean_stats AS (UNPIVOT mean_wide ON {', '.join(num)} INTO NAME col VALUE value)")
    ctes.append("stats AS (SELECT * FROM mode_stats UNION ALL SELECT * FROM mean_stats)")
    return ctes


def _round_all(cols, doubles, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" if c in doubles else c for c in cols)


def _interval_doubles():
    return set(_interval_columns()) - {SPEC.id_col, "visit", "label", "data_type"}


# --- statements ---------------------------------------------------------------

def panel_join():
    feats = list(EVENT_TYPES) + ["income", "active", "tier"]
    names = (["RID", "DMCASE", "DMSTATUS_SUB"] + [f"V{k}_{f.upper()}" for k in V for f in feats]
             + [f"AS{k}_AGE" for k in V] + ["AS1_AREA", "AS1_EDUA", "V1_FDM_REL", "V1_HOUSE", "AS1_SEX"])
    return _cte(*_event_ctes()) + f"SELECT {', '.join(f'{n} AS {n.lower()}' for n in names)} FROM merged"


def income_scale():
    cols = ", ".join(f"round(V{k}_INCOME, 9) AS V{k}_INCOME" for k in V)
    return _cte(*_event_ctes(scale_income=True)) + f"SELECT RID, {cols} FROM cohort"


def clean_missing():
    return _cte(*_event_ctes()) + "SELECT * FROM meas"


def carry_forward():
    return _cte(*_panel_ctes()) + "SELECT * FROM carried"


def transition_codes():
    codes = []
    for f in SPEC.nominal:
        cols = ", ".join(_fv(k, f) for k in V)
        a, b = f"list_extract([{cols}], vv)", f"list_extract([{cols}], vv + 1)"
        codes.append(f"{_code(a, b, SPEC.n_levels(f))} AS {f}_code")
    return (_cte(*_panel_ctes()) + f"SELECT rid, CAST(vv AS INTEGER) AS visit, {', '.join(codes)} "
            f"FROM (SELECT *, unnest(range(1, {SPEC.n_visits})) AS vv FROM carried)")


def intervals(outcome):
    return _cte(*_panel_ctes(), *_interval_ctes(outcome, "iv")) + "SELECT * FROM iv"


def sentinel_to_null():
    return _cte(*_null_ctes(False)) + "SELECT * FROM nul"


def impute_stats(kind):
    src = "mode_stats" if kind == "mode" else "mean_stats"
    return (_cte(*_stats_ctes(False)) +
            f'SELECT data_type, col AS "column", round(value, 6) AS value FROM {src}')


def preprocess_union():
    ctes = _stats_ctes(True)
    sel = []
    for c in _interval_columns():
        if c in (SPEC.id_col, "visit", "label", "data_type"):
            sel.append(c)
        else:
            sel.append(f"coalesce({c}, (SELECT s.value FROM stats s WHERE s.data_type = nul.data_type "
                       f"AND s.col = '{c}')) AS {c}")
    ctes.append(f"imputed AS (SELECT {', '.join(sel)} FROM nul)")
    return _cte(*ctes) + f"SELECT {_round_all(_interval_columns(), _interval_doubles())} FROM imputed"


def preprocess_raw():
    ctes = _all_intervals_ctes(True)
    return _cte(*ctes) + f"SELECT {_round_all(_interval_columns(), _interval_doubles())} FROM iv"


def intervals_long():
    return (_cte(*_panel_ctes(), *_interval_ctes("diag", "iv1"), *_interval_ctes("drug", "iv2"))
            + "SELECT * FROM iv1 UNION ALL SELECT * FROM iv2")


def training_round_trip():
    return f"SELECT * EXCLUDE (data_type) FROM ({preprocess_union()}) WHERE data_type = 'diag'"


def seeded_sample():
    from .catalog import SAMPLE_SEED
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"SELECT {', '.join(keys)} FROM lineitem ORDER BY md5(concat_ws(':', '{SAMPLE_SEED}', {text})), "
            f"{', '.join(keys)} LIMIT 1000")


def block_correlations():
    from .catalog import EVENT_BLOCKS
    have = set(_interval_columns())
    cols = list(dict.fromkeys(c for block in EVENT_BLOCKS.values() for c in block if c in have))
    pairs = [f"SELECT '{a}' AS first, '{b}' AS second, CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN 0.0 "
             f"ELSE round(corr({a}, {b}), 6) END AS correlation FROM rows"
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    return f"WITH rows AS MATERIALIZED ({training_round_trip()}) " + " UNION ALL ".join(pairs)


PREPROCESS_ORACLES = {
    "intervals_long": intervals_long,
    "training_round_trip": training_round_trip,
    "seeded_sample": seeded_sample,
    "block_correlations": block_correlations,
    "panel_join": panel_join,
    "income_scale": income_scale,
    "clean_missing": clean_missing,
    "carry_forward": carry_forward,
    "transition_codes": transition_codes,
    "intervals_diag": lambda: intervals("diag"),
    "intervals_drug": lambda: intervals("drug"),
    "sentinel_to_null": sentinel_to_null,
    "impute_mode": lambda: impute_stats("mode"),
    "impute_mean": lambda: impute_stats("mean"),
    "preprocess_union": preprocess_union,
    "preprocess_raw": preprocess_raw,
}




# --- evaluation ---------------------------------------------------------------

from ..sources.predictions import SCORE_MODELS  # noqa: E402

_MODELS = list(SCORE_MODELS)


def _pred_ctes():
    scores = ", ".join(f"CAST({e} AS DOUBLE) AS {m}" for m, e in SCORE_MODELS.items())
    return [
        "li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linestatus = 'F' "
        "THEN 'validation' ELSE 'test' END AS split, CAST(l_returnflag = 'R' AS INTEGER) AS label, "
        f"{scores} FROM lineitem)",
        f"p AS (UNPIVOT li ON {', '.join(_MODELS)} INTO NAME model VALUE prob)",
    ]


def _auc_ctes(src="p"):
    return [
        f"c AS (SELECT model, split, prob AS score, CAST(sum(label) AS BIGINT) AS pos, "
        f"CAST(sum(1 - label) AS BIGINT) AS neg FROM {src} GROUP BY model, split, prob)",
        "w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, split ORDER BY score ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM c)",
        "auc AS (SELECT model, split, CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / "
        "(CAST(2 AS DOUBLE) * CAST(sum(pos) AS BIGINT) * CAST(sum(neg) AS BIGINT)) AS auc, "
        "CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM w GROUP BY model, split)",
    ]


def roc_auc():
    return _cte(*_pred_ctes(), *_auc_ctes()) + "SELECT * FROM auc"


def roc_points():
    part = "PARTITION BY model, split"
    ctes = _pred_ctes() + _auc_ctes()[:1] + [
        f"r AS (SELECT *, sum(pos) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp, "
        f"sum(neg) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp, "
        f"lead(pos) OVER ({part} ORDER BY score DESC) AS next_pos, "
        f"lead(neg) OVER ({part} ORDER BY score DESC) AS next_neg, "
        f"row_number() OVER ({part} ORDER BY score DESC) AS rn, "
        f"sum(pos) OVER ({part}) AS P_, sum(neg) OVER ({part}) AS N_ FROM c)"]
    return (_cte(*ctes) + "SELECT model, split, score AS threshold, CAST(fp AS DOUBLE) / N_ AS fpr, "
            "CAST(tp AS DOUBLE) / P_ AS tpr FROM r WHERE rn = 1 OR next_pos IS NULL OR next_pos != pos "
            "OR next_neg != neg UNION ALL SELECT DISTINCT model, split, CAST('inf' AS DOUBLE), "
            "CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM c")


def _rates_sql(tp, fp, P_, N_):
    fn, tn = f"({P_} - {tp})", f"({N_} - {fp})"
    return (f"CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / ({tp} + {fp}) END",
            f"CASE WHEN {P_} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / {P_} END",
            f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0 ELSE (CAST(2 AS DOUBLE) * {tp}) / "
            f"(2 * {tp} + {fp} + {fn}) END",
            f"CAST({tp} + {tn} AS DOUBLE) / ({P_} + {N_})")


def confusion_at_cutoff():
    pr, rc, f1, acc = _rates_sql("tp", "fp", "P_", "N_")
    return (_cte(*_pred_ctes(), "g AS (SELECT model, split, CAST(sum(CASE WHEN prob >= 0.5 THEN label "
                 "ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN prob >= 0.5 THEN 1 - label ELSE 0 END) "
                 "AS BIGINT) AS fp, CAST(sum(label) AS BIGINT) AS P_, CAST(sum(1 - label) AS BIGINT) AS N_ "
                 "FROM p GROUP BY model, split)")
            + f"SELECT model, split, tp, fp, P_ - tp AS fn, N_ - fp AS tn, {pr} AS precision, "
              f"{rc} AS recall, {f1} AS f1, {acc} AS accuracy FROM g")


def best_cutoff():
    pr, rc, f1, acc = _rates_sql("tp", "fp", "P_", "N_")
    ctes = _pred_ctes() + [
        "grid AS (SELECT range AS j, CAST(0.01 AS DOUBLE) + CAST(range - 1 AS DOUBLE) * CAST(0.01 AS DOUBLE) "
        "AS cutoff FROM range(1, 100))",
        "tot AS (SELECT model, split, CAST(sum(label) AS BIGINT) AS P_, CAST(sum(1 - label) AS BIGINT) AS N_ "
        "FROM p GROUP BY model, split)",
        "cm AS (SELECT p.model, p.split, grid.j, grid.cutoff, CAST(sum(CASE WHEN p.prob >= grid.cutoff THEN "
        "p.label ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN p.prob >= grid.cutoff THEN 1 - p.label "
        "ELSE 0 END) AS BIGINT) AS fp FROM p CROSS JOIN grid GROUP BY p.model, p.split, grid.j, grid.cutoff)",
        f"m AS (SELECT cm.*, tot.P_, tot.N_, {f1} AS f1, {pr} AS precision, {rc} AS recall, {acc} AS accuracy "
        "FROM cm JOIN tot USING (model, split))",
        "pick AS (SELECT model, j, f1 AS validation_f1 FROM (SELECT model, j, f1, row_number() OVER "
        "(PARTITION BY model ORDER BY f1 DESC, j ASC) AS rn FROM m WHERE split = 'validation') WHERE rn = 1)",
    ]
    return (_cte(*ctes) + "SELECT m.model, m.cutoff, m.precision, m.recall, m.f1, m.accuracy, "
            "pick.validation_f1 FROM m JOIN pick ON m.model = pick.model AND m.j = pick.j "
            "WHERE m.split = 'test'")


def ensemble_mean():
    keys = "l_orderkey, l_linenumber, l_partkey, l_suppkey, split"
    return (_cte(*_pred_ctes()) + f"SELECT {keys}, 'Ensemble' AS model, max(label) AS label, "
            f"round(avg(prob), 9) AS prob FROM p GROUP BY {keys}")


def auc_ranking():
    total = " + ".join(_MODELS)
    ctes = _pred_ctes()[:1] + [
        f"lie AS (SELECT *, ({total}) / {len(_MODELS)} AS Ensemble FROM li)",
        f"p AS (UNPIVOT lie ON {', '.join(_MODELS + ['Ensemble'])} INTO NAME model VALUE prob)",
    ] + _auc_ctes()
    ctes.append("s AS (SELECT model, max(CASE WHEN split = 'validation' THEN auc END) AS auc_validation, "
                "max(CASE WHEN split = 'test' THEN auc END) AS auc_test FROM auc GROUP BY model)")
    return (_cte(*ctes) + "SELECT model, auc_validation, auc_test, CAST(row_number() OVER "
            "(ORDER BY auc_test DESC, model) AS INTEGER) AS rank FROM s")


def feature_stats():
    parts = [f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(var_pop({c}), 6) AS var_pop, "
             f"round(sqrt(var_pop({c})), 6) AS sd FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")]
    return " UNION ALL ".join(parts)


METRIC_ORACLES = {
    "roc_auc": roc_auc,
    "roc_points": roc_points,
    "confusion_at_cutoff": confusion_at_cutoff,
    "best_cutoff": best_cutoff,
    "ensemble_mean": ensemble_mean,
    "auc_ranking": auc_ranking,
    "feature_stats": feature_stats,
}


# --- splitting ------------------------------------------------------------------

_ORDERS = ("o AS (SELECT o_custkey AS rid, o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label "
           "FROM orders)")
_SUMMARY = ("s AS (SELECT rid, count(*) AS total, CAST(sum(label) AS BIGINT) AS positive, "
            "count(*) - CAST(sum(label) AS BIGINT) AS negative FROM o GROUP BY rid)")
_STRATA = ("CASE WHEN positive = 0 THEN 'only_0' WHEN negative = 0 THEN 'only_1' ELSE 'mixed' END")


def rid_strata():
    return _cte(_ORDERS, _SUMMARY) + f"SELECT *, {_STRATA} AS strata FROM s"


def strata_counts():
    return _cte(_ORDERS, _SUMMARY) + f"SELECT {_STRATA} AS strata, count(*) AS n_rids FROM s GROUP BY 1"


def split_sizes():
    first, second = P.FIRST_HOLDOUT, P.SECOND_HOLDOUT
    return _cte(_ORDERS, "n AS (SELECT count(DISTINCT rid) AS n FROM o)",
                f"h AS (SELECT n, CAST(ceil(n * CAST({first} AS DOUBLE)) AS BIGINT) AS nh FROM n)",
                f"h2 AS (SELECT n, nh, CAST(ceil(nh * CAST({second} AS DOUBLE)) AS BIGINT) AS nt FROM h)") + (
        "SELECT 'train' AS split, n - nh AS n_rids FROM h2 UNION ALL "
        "SELECT 'validation', nh - nt FROM h2 UNION ALL SELECT 'test', nt FROM h2")


def _md5_rank(key, part):
    return (f"row_number() OVER (PARTITION BY {part} ORDER BY md5('{P.SPLIT_SEED}:' || {key}), {key})")


def _holdout_ctes(step, source, share):
    """Quota of each stratum of ``source`` (rid, strata) by the largest remainders; ``step`` names the tables."""
    c, t, q, o = (f"{x}{step}" for x in "ctqo")
    return [
        f"{c} AS (SELECT strata, count(*) AS c FROM {source} GROUP BY strata)",
        f"{t} AS (SELECT CAST(sum(c) AS BIGINT) AS n, CAST(ceil(sum(c) * CAST({share} AS DOUBLE)) AS BIGINT) AS nt, "
        f"count(*) AS k, min(c) AS least FROM {c})",
        f"{q} AS (SELECT strata, c, floor(CAST((n - nt) * c AS DOUBLE) / n) AS base, "
        f"CAST((n - nt) * c AS DOUBLE) / n - floor(CAST((n - nt) * c AS DOUBLE) / n) AS rest, n - nt AS want, "
        f"k >= 2 AND least >= 2 AND n - nt >= k AND nt >= k AS strat, nt FROM {c}, {t})",
        f"{o} AS (SELECT strata, strat, CAST(CASE WHEN strat THEN c - base - CASE WHEN row_number() OVER (ORDER BY "
        f"rest DESC, strata) <= want - sum(base) OVER () THEN 1 ELSE 0 END ELSE nt END AS BIGINT) AS quota FROM {q})"]


def _split_ctes():
    return [_ORDERS, _SUMMARY, f"p AS (SELECT rid, {_STRATA} AS strata, positive, negative FROM s)",
            *_holdout_ctes(1, "p", P.FIRST_HOLDOUT),
            f"r1 AS (SELECT p.*, quota, {_md5_rank('p.rid', 'CASE WHEN strat THEN p.strata END')} AS k "
            "FROM p JOIN o1 USING (strata))",
            "held AS (SELECT rid, strata FROM r1 WHERE k <= quota)",
            *_holdout_ctes(2, "held", P.SECOND_HOLDOUT),
            f"r2 AS (SELECT held.rid, quota, {_md5_rank('held.rid', 'CASE WHEN strat THEN held.strata END')} AS k "
            "FROM held JOIN o2 USING (strata))",
            "a AS (SELECT r1.rid, CASE WHEN r2.rid IS NULL THEN 'train' WHEN r2.k <= r2.quota THEN 'test' "
            "ELSE 'validation' END AS split FROM r1 LEFT JOIN r2 ON r1.rid = r2.rid)"]


def rid_split():
    return _cte(*_split_ctes()) + "SELECT rid, split FROM a"


def _oversample_ctes():
    num = f"CAST('0x' || substr(md5('{P.SPLIT_SEED}:train:' || d.i), 1, 15) AS BIGINT) % m + 1"
    return [*_split_ctes(), "e AS (SELECT rid, o_orderkey, label, split FROM o JOIN a USING (rid))",
            f"pos AS (SELECT *, {_md5_rank('o_orderkey', '1')} AS num FROM e WHERE split = 'train' AND label = 1)",
            "m AS (SELECT count(*) AS m FROM pos)",
            "n AS (SELECT greatest((SELECT m FROM m), count(*) FILTER (label = 0)) AS n FROM e WHERE split = 'train')",
            f"d AS (SELECT i, {num} AS num FROM (SELECT unnest(range(n)) AS i FROM n) d, m)",
            "ov AS (SELECT rid, o_orderkey, label, split, CAST(0 AS BIGINT) AS copy FROM e "
            "WHERE NOT (split = 'train' AND label = 1) "
            "UNION ALL SELECT rid, o_orderkey, label, split, i + 1 FROM d JOIN pos USING (num))"]


def oversample():
    return _cte(*_oversample_ctes()) + "SELECT * FROM ov"


def oversample_sizes():
    return _cte(*_oversample_ctes()) + "SELECT split, label, count(*) AS n_rows FROM ov GROUP BY split, label"


SPLIT_ORACLES = {
    "rid_strata": rid_strata,
    "strata_counts": strata_counts,
    "rid_split": rid_split,
    "split_sizes": split_sizes,
    "oversample": oversample,
    "oversample_sizes": oversample_sizes,
}


# --- category strings and one-hot positions ---------------------------------------

def _string_ctes():
    cat = _categorical()
    cols = []
    for c in cat:
        int_like = (f"((SELECT count(*) FROM pu WHERE {c} IS NOT NULL AND {c} <> floor({c})) = 0 "
                    f"AND (SELECT count({c}) FROM pu) > 0)")
        cols.append(f"CASE WHEN {int_like} THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) "
                    f"ELSE CAST({c} AS VARCHAR) END AS {c}")
    return [f"pu AS ({preprocess_union()})",
            f"ns AS (SELECT rid, visit, data_type, {', '.join(cols)} FROM pu)"]


def nominal_strings():
    return _cte(*_string_ctes()) + "SELECT * FROM ns"


def one_hot():
    cols = []
    for c in _categorical():
        cols.append(f"CAST(CASE WHEN {c} IS NULL THEN (SELECT count(DISTINCT {c}) FROM ns) "
                    f"ELSE dense_rank() OVER (ORDER BY {c}) - 1 END AS INTEGER) AS {c}_hot")
    return _cte(*_string_ctes()) + f"SELECT rid, visit, data_type, {', '.join(cols)} FROM ns"


def one_hot_slots():
    parts = [f"SELECT '{c}' AS category, CAST(row_number() OVER (ORDER BY {c} NULLS LAST) - 1 AS INTEGER) AS slot, "
             f"coalesce({c}, '__unknown') AS name FROM (SELECT DISTINCT {c} FROM ns WHERE {c} IS NOT NULL "
             f"UNION ALL SELECT NULL)" for c in _categorical()]
    return _cte(*_string_ctes()) + " UNION ALL ".join(parts)


FEATURE_ORACLES = {
    "nominal_strings": nominal_strings,
    "one_hot": one_hot,
    "one_hot_slots": one_hot_slots,
}


def all_oracles() -> dict:
    out = {k: f() for k, f in PREPROCESS_ORACLES.items()}
    out.update({k: f() for k, f in METRIC_ORACLES.items()})
    out.update({k: f() for k, f in SPLIT_ORACLES.items()})
    out.update({k: f() for k, f in FEATURE_ORACLES.items()})
    return out
