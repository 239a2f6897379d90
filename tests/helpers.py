"""Small hand-made panels for unit tests."""

from cohortlens.spec import PanelSpec

SPEC = PanelSpec(features=("x", "pa", "smoke"), binary=("pa",), ternary=("smoke",),
                 base_columns=("as1_edua", "v1_house"))


def panel_row(rid, dmcase, status=None, x=None, pa=None, smoke=None, age=None, edua=1.0, house=1.0,
              spec=SPEC):
    """Raw wide row: missing values default to None; lists give per-visit values."""
    n = spec.n_visits
    x = x or [float(10 * k) for k in range(1, n + 1)]
    pa = pa or [0.0] * n
    smoke = smoke or [0.0] * n
    age = age or [float(40 + k) for k in range(1, n + 1)]
    row = {"rid": rid, "dmcase": dmcase, "dmstatus_sub": status, "as1_edua": edua, "v1_house": house}
    for k in range(1, n + 1):
        row[f"as{k}_age"] = age[k - 1]
        row[f"v{k}_x"] = x[k - 1]
        row[f"v{k}_pa"] = pa[k - 1]
        row[f"v{k}_smoke"] = smoke[k - 1]
    return row


def panel_schema(spec=SPEC, dmcase_type="double"):
    cols = ["rid long", f"dmcase {dmcase_type}", "dmstatus_sub double"]
    cols += [f"{c} double" for c in spec.base_columns]
    for k in spec.visits():
        cols.append(f"as{k}_age double")
        for f in spec.features:
            cols.append(f"v{k}_{f} double")
    return ", ".join(cols)


def make_panel(spark, rows, spec=SPEC, dmcase_type="double"):
    schema = panel_schema(spec, dmcase_type)
    names = [c.split(" ")[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
