"""Fixed values of the study the library reproduces.

Everything in this module is a constant the results depend on (column
names, codes, sizes). Operators never read these directly: they take a
``PanelSpec`` or explicit lists, with these values as the default preset.
"""

from __future__ import annotations

# --- fixed values: missing-value coding -------------------------------------
MISSING_SENTINEL = 99999.0
SENTINEL_THRESHOLD = 90000.0
N_VISITS = 10

# --- fixed values: participant panel ----------------------------------------
ID_COL = "rid"
RAW_ID_COL = "RID"
STATUS_COLUMNS = ("dmcase", "dmstatus_sub")
BASE_COLUMNS = ("as1_area", "as1_edua", "v1_fdm_rel", "v1_house", "as1_sex")
LONGITUDINAL_FEATURES = (
    "sbp", "dbp", "bmi", "weight", "waist_avg", "pa", "smoke", "packyr_current",
    "drink", "totalc", "htfdcst", "medcst", "urinfqlnc", "wafqlnc", "income",
    "alt", "ast", "bun", "creatinine", "hb", "hct", "hdl", "crp", "ins0",
    "ins120", "ins60", "plat", "rbc", "tchl", "tg", "wbc", "glu0", "glu120",
    "hba1c",
)
# binary nominal: 0->0 = 1, 0->1 = 2, 1->0 = 3, 1->1 = 4
BINARY_FEATURES = ("pa", "urinfqlnc", "wafqlnc")
# ternary nominal: prev * 3 + next + 1 for values in {0, 1, 2}
TERNARY_FEATURES = ("smoke", "drink")
DRUG_BASELINE_DROP_COLUMNS = ("as1_edua", "v1_house")
INCOME_FEATURE = "income"
INCOME_DIVISOR = 10000.0

# status codes that exclude a participant from one outcome
DIAG_EXCLUDED_STATUS = 1.1
DRUG_EXCLUDED_STATUS = 1.2

# --- fixed values: feature groups (each level followed by its change) -------
BIO_BASE = ("tchl", "hdl", "tg", "alt", "ast", "bun", "creatinine", "crp",
            "wbc", "rbc", "plat", "hct", "hb")
PHYSICAL_BASE = ("weight", "bmi", "waist_avg", "sbp", "dbp")
LIFESTYLE_BASE = ("smoke", "packyr_current", "drink", "income", "medcst",
                  "htfdcst", "urinfqlnc", "wafqlnc", "pa", "totalc")


def with_changes(names):
    """``(a, b)`` -> ``(a, a_diff, b, b_diff)``."""
    return tuple(x for n in names for x in (n, f"{n}_diff"))


BIO_FEATURES = with_changes(BIO_BASE)
PHYSICAL_FEATURES = with_changes(PHYSICAL_BASE)
LIFESTYLE_FEATURES = with_changes(LIFESTYLE_BASE)
NON_INVASIVE_FEATURES = PHYSICAL_FEATURES + LIFESTYLE_FEATURES
ALL_MODELED_FEATURES = BIO_FEATURES + PHYSICAL_FEATURES + LIFESTYLE_FEATURES

# Blocks per feature set: what each set drops, and which blocks PCA builds.
FEATURE_BLOCKS = {
    "bio": BIO_FEATURES,
    "physical": PHYSICAL_FEATURES,
    "life": LIFESTYLE_FEATURES,
}
FEATURE_SET_DROPS = {
    "all": (),
    "bio": ("physical", "life"),
    "physical": ("bio", "life"),
    "life": ("bio", "physical"),
    "Non_invasive": ("bio",),
}
FEATURE_SET_PCA_BLOCKS = {
    "all": ("bio", "physical", "life"),
    "bio": ("bio",),
    "physical": ("physical",),
    "life": ("life",),
    "Non_invasive": ("Non_invasive",),
}
FEATURE_SETS = ("all", "bio", "physical", "life", "Non_invasive")
PCA_MODES = ("plus", "none", "only")
DROP_CONTAINS = ("ins0", "ins60", "ins120", "glu0", "glu120", "hba1c")

# --- fixed values: splitting and sampling -----------------------------------
SPLIT_SEED = 123
FIRST_HOLDOUT = 0.2
SECOND_HOLDOUT = 0.5
OVERSAMPLE_TARGETS = {"train": 36679, "test": 4584, "validation": 4584}

# --- fixed values: cutoff grid 0.01 .. 0.99 ---------------------------------
CUTOFF_START = 0.01
CUTOFF_STEP = 0.01
CUTOFF_COUNT = 99

# --- fixed values: model presets --------------------------------------------
MODEL_NAMES = ("LR", "RF", "XGB", "LGBM", "ANN", "RNN")
PCA_MAX_COMPONENTS = 10
PCA_VARIANCE = 0.9
