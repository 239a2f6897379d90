"""Interval builder, carry-forward and imputation: the quirks Q1-Q7 and the F7 edge rows."""

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import sqlexpr as X
from cohortlens.operators import impute as IM
from cohortlens.operators.intervals import build_intervals, drop_missing_baseline, transition_table
from cohortlens.operators.panel import (carry_forward, carry_forward_long, panel_to_long,
                                        prepare_panel, scale_income_columns, clean_measurements,
                                        merge_panels, lowercase_columns, validate_columns)
from cohortlens.plans.preprocess import preprocess
from cohortlens.spec import STUDY

from helpers import SPEC, make_panel, panel_row

S = 99999.0

# (dmcase, expected diag [(visit, label)], expected drug [(visit, label)])
TRUTH = [
    (1.0, [(1, 1)], []),
    (2.0, [(1, 0), (2, 1)], [(1, 1)]),
    (5.0, [(v, int(v == 5)) for v in range(1, 6)], [(v, int(v == 4)) for v in range(1, 5)]),
    (9.0, [(v, int(v == 9)) for v in range(1, 10)], [(v, int(v == 8)) for v in range(1, 9)]),
    (10.0, [(v, 0) for v in range(1, 10)], [(v, 0) for v in range(1, 10)]),
    (11.0, [(v, 0) for v in range(1, 9)], [(v, 0) for v in range(1, 9)]),
    (18.0, [(1, 0)], [(1, 0)]),
    (19.0, [], []),
    (None, [], []),
    (0.0, [], []),
    (S, [], []),
    (9.7, [(v, int(v == 9)) for v in range(1, 10)], [(v, int(v == 8)) for v in range(1, 9)]),
]


def _intervals(spark, rows, outcomes=("drug", "diag"), dmcase_type="double"):
    raw = make_panel(spark, rows, dmcase_type=dmcase_type)
    return build_intervals(carry_forward(prepare_panel(raw, SPEC), SPEC), SPEC, outcomes)


def test_truth_table(spark):
    rows = [panel_row(i, d) for i, (d, _, _) in enumerate(TRUTH)]
    got = _intervals(spark, rows).select("rid", "data_type", "visit", "label").collect()
    by = {}
    for r in got:
        by.setdefault((r.rid, r.data_type), []).append((r.visit, r.label))
    for i, (d, diag, drug) in enumerate(TRUTH):
        assert sorted(by.get((i, "diag"), [])) == diag, d
        assert sorted(by.get((i, "drug"), [])) == drug, d


def test_text_dmcase_gives_nothing(spark):
    rows = [panel_row(1, "text"), panel_row(2, "3")]
    got = _intervals(spark, rows, dmcase_type="string").groupBy("rid", "data_type").count().collect()
    assert {(r.rid, r.data_type): r["count"] for r in got} == {(2, "diag"): 3, (2, "drug"): 2}


def test_status_excludes_outcome(spark):
    rows = [panel_row(1, 3.0, status=1.1), panel_row(2, 3.0, status=1.2)]
    got = {(r.rid, r.data_type) for r in _intervals(spark, rows).collect()}
    assert got == {(1, "drug"), (2, "diag")}


def test_visit_beyond_panel_raises(spark):
    from cohortlens.spec import PanelSpec
    short = PanelSpec(features=("x",), binary=(), ternary=(), base_columns=(), n_visits=5)
    cols = ["rid long", "dmcase double", "dmstatus_sub double"] + \
        [f"as{k}_age double, v{k}_x double" for k in range(1, 6)]
    df = spark.createDataFrame([(1, 9.0, 0.0) + (1.0,) * 10], ", ".join(cols))
    with pytest.raises(Exception, match="n_visits"):
        build_intervals(df, short).collect()


def test_transition_codes(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (None, 1.0),
         (-0.5, 1.0), (1.9, 0.2), (float("nan"), 0.0)], "p double, q double")
    got = df.selectExpr(*[X.transition_code("p", "q", n, 99999.0) + f" AS {c}" for n, c in ((2, "b"), (3, "t"))]).collect()
    assert [r.b for r in got] == [1, 2, 3, 4, S, S, S, 2, 3, S]
    assert [r.t for r in got] == [1, 2, 4, 5, 8, S, S, 2, 4, S]


def test_sentinel_arithmetic_and_imputation(spark):
    n = SPEC.n_visits
    both_missing = [None, None] + [30.0] * (n - 2)
    first_missing = [None, 120.0] + [130.0] * (n - 2)
    second_missing = [120.0, None] + [140.0] * (n - 2)
    rows = [panel_row(1, 10.0, x=both_missing), panel_row(2, 10.0, x=first_missing),
            panel_row(3, 10.0, x=second_missing)]
    raw = _intervals(spark, rows, outcomes=("diag",)).filter("visit = 1")
    r = {x.rid: x for x in raw.collect()}
    assert r[1].x == S and r[1].x_diff == 0.0            # level missing, change a true 0
    assert r[2].x == S and r[2].x_diff == 120.0 - S      # change far below -90000
    assert r[3].x == 120.0 and r[3].x_diff == 0.0        # visit 2 carried from visit 1
    imp = {x.rid: x for x in IM.impute_intervals(_intervals(spark, rows, outcomes=("diag",)), SPEC)
           .filter("visit = 1").collect()}
    assert imp[1].x_diff == 0.0 and imp[1].x is not None and imp[1].x != S
    assert imp[2].x_diff is not None and abs(imp[2].x_diff) < 90000


def test_carry_forward_cascade(spark):
    n = SPEC.n_visits
    x = [5.0, None, None, 7.0] + [None] * (n - 4)
    raw = make_panel(spark, [panel_row(1, 10.0, x=x), panel_row(2, 10.0, x=[None] * n)])
    wide = carry_forward(prepare_panel(raw, SPEC), SPEC).orderBy("rid").collect()
    assert [wide[0][f"v{k}_x"] for k in range(1, n + 1)] == [5.0, 5.0, 5.0] + [7.0] * (n - 3)
    assert [wide[1][f"v{k}_x"] for k in range(1, n + 1)] == [S] * n


def test_carry_forward_long_matches_wide(spark):
    n = SPEC.n_visits
    rows = [panel_row(1, 10.0, x=[None, 3.0, None, None, 9.0] + [None] * (n - 5),
                      age=[None] * 3 + [50.0] * (n - 3)),
            panel_row(2, 4.0, x=[1.0] + [None] * (n - 1))]
    prepared = prepare_panel(make_panel(spark, rows), SPEC)
    wide = panel_to_long(carry_forward(prepared, SPEC), SPEC)
    long = carry_forward_long(panel_to_long(prepared, SPEC))
    key = ["rid", "feature", "visit"]
    a = sorted(tuple(r) for r in wide.select(*key, "value").collect())
    b = sorted(tuple(r) for r in long.select(*key, "value").collect())
    assert a == b


def test_mode_ties_and_all_null(spark):
    df = spark.createDataFrame(
        [(1, 1, "diag", 1.0, None, 1.0), (2, 1, "diag", 3.0, None, 2.0), (3, 1, "diag", None, None, None)],
        "rid long, visit int, data_type string, pa double, smoke double, x double")
    model = IM.fit_imputer(df, ["pa", "smoke"])
    out = {r.rid: r for r in model.transform(df).collect()}
    assert out[3].pa == 1.0                  # tie between 1 and 3 -> smallest
    assert out[3].smoke is None              # all-null column stays null
    assert out[3].x == 1.5                   # mean


def test_imputation_is_per_data_type(spark):
    df = spark.createDataFrame([(1, "diag", 1.0), (2, "diag", None), (3, "drug", 10.0), (4, "drug", None)],
                               "rid long, data_type string, x double")
    out = {r.rid: r.x for r in IM.fit_imputer(df, []).transform(df).collect()}
    assert out[2] == 1.0 and out[4] == 10.0


def test_drug_rows_with_missing_baseline_dropped(spark):
    rows = [panel_row(1, 3.0, house=None), panel_row(2, 3.0)]
    got = drop_missing_baseline(_intervals(spark, rows), SPEC)
    kinds = {(r.rid, r.data_type) for r in got.collect()}
    assert (1, "drug") not in kinds and (1, "diag") in kinds and (2, "drug") in kinds


def test_income_scaling(spark):
    df = spark.createDataFrame([(1, 2500000.0, None, S), (2, 3.0, "x", 7.0)],
                               "RID long, V1_INCOME double, V2_INCOME string, V3_INCOME double")
    out = {r.RID: r for r in scale_income_columns(df, STUDY).collect()}
    assert out[1].V1_INCOME == 250.0 and out[1].V2_INCOME is None and out[1].V3_INCOME == S
    assert out[2].V2_INCOME is None and out[2].V3_INCOME == 7.0 / 10000


def test_measurement_cleaning_and_join(spark):
    meas = spark.createDataFrame([(1, ".", "2"), (None, "3", "4")], "RID long, A string, B string")
    clean = clean_measurements(meas)
    assert [r.A for r in clean.orderBy("B").collect()] == [S, 3.0]
    cohort = spark.createDataFrame([(1, 5.0), (None, 6.0)], "RID long, C double")
    joined = merge_panels(cohort, clean, null_keys=True).collect()
    assert sorted((r.C, r.A) for r in joined) == [(5.0, S), (6.0, 3.0)]   # null key matches null key
    with pytest.raises(Exception, match="null_keys"):
        merge_panels(cohort, clean).collect()
    keyed = clean_measurements(spark.createDataFrame([(".", "1"), ("2", "3")], "RID string, A string"))
    assert sorted(r.RID for r in keyed.collect()) == ["2", "99999"]
    bad = spark.createDataFrame([(1, "oops")], "RID long, A string")
    with pytest.raises(Exception, match="holds the text"):
        clean_measurements(bad).collect()


def test_validation_and_lowercase(spark):
    df = spark.createDataFrame([(1, 2)], "A long, a long")
    with pytest.raises(ValueError, match="collide"):
        lowercase_columns(df)
    with pytest.raises(ValueError, match=r"\+"):
        validate_columns(spark.createDataFrame([(1,)], "rid long"), STUDY.required_columns())


def test_study_preset_end_to_end(spark):
    """The study's 358-column panel compiles and yields 77 columns + tag."""
    cols = STUDY.required_columns()
    row = {c: 1.0 for c in cols}
    row.update(rid=1, dmcase=3.0, dmstatus_sub=None)
    schema = ", ".join(f"`{c}` {'long' if c == 'rid' else 'double'}" for c in cols)
    cohort = spark.createDataFrame([tuple(row[c] for c in cols)], schema)
    cohort = cohort.toDF(*[c.upper() if c == "rid" else c for c in cols])
    meas = spark.createDataFrame([(1, "5")], "RID long, extra string")
    out = preprocess(cohort, meas, STUDY)
    assert out.count() == 3 + 2
    assert len(out.columns) == 2 + 75 + 1     # rid, visit, label, 5 base, age, 34 + 34, tag


def test_transition_table(spark):
    rows = [panel_row(1, 10.0, pa=[0.0, 1.0] * 5, smoke=[2.0, 1.0] * 5)]
    t = transition_table(carry_forward(prepare_panel(make_panel(spark, rows), SPEC), SPEC), SPEC)
    got = {r.visit: (r.pa_code, r.smoke_code) for r in t.collect()}
    assert got[1] == (2.0, 8.0) and got[2] == (3.0, 6.0) and len(got) == 9


def test_interval_plan_columns(spark):
    df = spark.createDataFrame([(2.0, 0.0), (1.0, 0.0), (25.0, 0.0)], "d double, s double")
    got = df.selectExpr(*[f"{x} AS {n}" for x, n in zip(X.interval_plan("d", "s", "drug", 1.2), ("n", "pos"))]).collect()
    assert [(r.n, r.pos) for r in got] == [(1, 1), (0, None), (0, None)]


def test_imputed_rows_are_not_shuffled_by_row_type(spark):
    """Two row types as the key of a shuffle would bring all rows to two tasks: the statistics go to the rows."""
    from cohortlens.operators.impute import impute_intervals
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([(1, 1, 0, "diag", 1.0), (2, 1, 1, "drug", None)],
                                     "rid long, visit int, label int, data_type string, x double")
        plan = impute_intervals(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
