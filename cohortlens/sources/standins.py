"""Stand-in inputs built from the driver's tables.

These functions only reshape the given tables into the raw schemas the
library expects (a wide cohort panel with upper-case names and gaps as
nulls, and a measurement table whose cells are text with ``.`` for
missing). They do none of the library's work: no sentinel coding, no
carry-forward, no intervals.

Event panel: ``events`` spans 30 days; visit = 3-day period (1..10),
participant = ``user_id``, feature = event type, cell = max(value).
Order panel: ``orders`` + ``lineitem`` by customer and 8-month period from
1995-01 (1..10), used for the larger bench panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import PanelSpec

# fixed values: the driver's event types, segment codes and period origins
EVENT_TYPES = ("click", "view", "signup", "error", "purchase")
EVENT_ORIGIN = "2024-01-01"
EVENT_PERIOD_DAYS = 3
ORDER_ORIGIN_YEAR = 1995
ORDER_PERIOD_MONTHS = 8
SEGMENT_CODES = {"AUTOMOBILE": "1", "BUILDING": "2", "FURNITURE": "3",
                 "HOUSEHOLD": "4", "MACHINERY": "5"}
N_VISITS = 10

EVENT_SPEC = PanelSpec(
    features=EVENT_TYPES + ("income", "active", "tier"),
    binary=("active",),
    ternary=("tier",),
)

ORDER_SPEC = PanelSpec(
    features=("n_orders", "spend", "top_price", "quantity", "discount", "tax", "income",
              "urgent", "state"),
    binary=("urgent",),
    ternary=("state",),
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _type_code():
    """Event type as its position in EVENT_TYPES (numeric, so aggregation
    buffers stay fixed-width and hash aggregation applies)."""
    code = F.lit(len(EVENT_TYPES))
    for i, t in reversed(list(enumerate(EVENT_TYPES))):
        code = F.when(F.col("event_type") == t, F.lit(i)).otherwise(code)
    return code


def event_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw wide cohort from ``events``: RID, DMCASE, DMSTATUS_SUB, AS{k}_AGE, V{k}_{F}.

    Cells: max value per event type; INCOME = summed purchase value; ACTIVE =
    view value above 30 (binary); TIER = purchase value in thirds of 0..360
    (ternary); AS{k}_AGE = number of events. DMCASE = first period with a
    purchase above 120 whose ``props.k`` is at least 50; with none, 20 - last active period when that
    is before period 10, else 10. DMSTATUS_SUB from the first event's type.
    """
    ev = read_table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_type", "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"))
    ev = ev.withColumn("visit", F.floor(F.datediff(F.to_date("ts"), F.lit(EVENT_ORIGIN))
                                        / EVENT_PERIOD_DAYS).cast("int") + 1)
    cell_aggs = [F.max(F.when(F.col("event_type") == t, F.col("value"))).alias(t) for t in EVENT_TYPES]
    cells = (ev.groupBy("user_id", "visit")
             .agg(*cell_aggs,
                  F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("income"),
                  F.count(F.lit(1)).cast("double").alias("age"),
                  F.min_by(_type_code(), "ts").alias("__ft"), F.min("ts").alias("__fts"),
                  F.max(((F.col("event_type") == "purchase") & (F.col("value") > 120)
                         & (F.col("k") >= 50)).cast("int")).alias("__hit")))
    cells = cells.withColumns({
        "active": F.when(F.col("view").isNotNull(), (F.col("view") > 30).cast("double")),
        "tier": F.when(F.col("purchase").isNotNull(),
                       F.least(F.floor(F.col("purchase") / 120), F.lit(2)).cast("double")),
    })
    feats = list(EVENT_TYPES) + ["income", "active", "tier"]
    aggs = [F.max(F.when(F.col("visit") == k, F.col(f))).alias(f"V{k}_{f.upper()}")
            for k in range(1, N_VISITS + 1) for f in feats]
    aggs += [F.max(F.when(F.col("visit") == k, F.col("age"))).alias(f"AS{k}_AGE")
             for k in range(1, N_VISITS + 1)]
    aggs += [F.min(F.when(F.col("__hit") == 1, F.col("visit"))).alias("__event"),
             F.max("visit").alias("__last"), F.min_by("__ft", "__fts").alias("__first")]
    wide = cells.groupBy("user_id").agg(*aggs)
    dmcase = (F.when(F.col("__event").isNotNull(), F.col("__event"))
              .when(F.col("__last") < N_VISITS, F.lit(20) - F.col("__last"))
              .otherwise(F.lit(N_VISITS))).cast("double")
    status = (F.when(F.col("__first") == EVENT_TYPES.index("error"), F.lit(1.1))
              .when(F.col("__first") == EVENT_TYPES.index("signup"), F.lit(1.2)))
    out = wide.select(
        F.col("user_id").alias("RID"), dmcase.alias("DMCASE"), status.alias("DMSTATUS_SUB"),
        *[c for c in wide.columns if c.startswith(("V", "AS"))])
    return out


def customer_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurement table from ``customer``: RID first, text cells, ``.`` = missing."""
    c = read_table(spark, sf_dir, "customer")
    seg = F.lit(".")
    for name, code in SEGMENT_CODES.items():
        seg = F.when(F.col("c_mktsegment") == name, F.lit(code)).otherwise(seg)
    return c.select(
        F.col("c_custkey").alias("RID"),
        F.col("c_nationkey").cast("string").alias("AS1_AREA"),
        seg.alias("AS1_EDUA"),
        F.when(F.col("c_acctbal") < 5000, F.lit("0")).otherwise(F.lit("1")).alias("V1_FDM_REL"),
        F.when(F.col("c_acctbal") < 0, F.lit("."))
         .otherwise(F.floor(F.col("c_acctbal") / 2500).cast("string")).alias("V1_HOUSE"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("1")).otherwise(F.lit("2")).alias("AS1_SEX"),
    )


def order_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw wide cohort from ``orders`` and ``lineitem`` by customer and 8-month period.

    Line items are summed per order first (partial aggregate on the big
    table, its output partitioned by order key so the join to orders moves
    only the orders side).
    """
    li = (read_table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("disc"),
               F.avg("l_tax").alias("tx")))
    o = read_table(spark, sf_dir, "orders")
    months = ((F.year("o_orderdate") - ORDER_ORIGIN_YEAR) * 12 + F.month("o_orderdate") - 1)
    o = o.withColumn("visit", F.floor(months / ORDER_PERIOD_MONTHS).cast("int") + 1)
    # first order = earliest date, then lowest key, packed into one long
    # (days since 1970 above bit 40, order key below) so buffers stay numeric
    o = o.withColumns({
        "__order": F.shiftleft(F.datediff(F.col("o_orderdate"), F.lit("1970-01-01")).cast("long"), 40)
        + F.col("o_orderkey"),
        "__prio": F.substring("o_orderpriority", 1, 1).try_cast("int")})
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    cells = (j.groupBy("o_custkey", "visit")
             .agg(F.count(F.lit(1)).cast("double").alias("n_orders"),
                  F.sum("o_totalprice").alias("spend"),
                  F.max("o_totalprice").alias("top_price"),
                  F.sum("qty").alias("quantity"),
                  F.avg("disc").alias("discount"),
                  F.avg("tx").alias("tax"),
                  (F.sum("o_totalprice") * 10).alias("income"),
                  F.max((F.col("o_orderpriority") == "1-URGENT").cast("double")).alias("urgent"),
                  F.max(F.when(F.col("o_orderstatus") == "F", 0.0)
                        .when(F.col("o_orderstatus") == "O", 1.0).otherwise(2.0)).alias("state"),
                  F.min_by("__prio", "__order").alias("__fp"), F.min("__order").alias("__fk")))
    feats = list(ORDER_SPEC.features)
    aggs = [F.max(F.when(F.col("visit") == k, F.col(f))).alias(f"V{k}_{f.upper()}")
            for k in range(1, N_VISITS + 1) for f in feats]
    aggs += [F.max(F.when(F.col("visit") == k, F.col("n_orders") * 5 + 30)).alias(f"AS{k}_AGE")
             for k in range(1, N_VISITS + 1)]
    aggs += [F.min(F.when(F.col("top_price") > 400000, F.col("visit"))).alias("__event"),
             F.max("visit").alias("__last"), F.min_by("__fp", "__fk").alias("__first")]
    wide = cells.groupBy("o_custkey").agg(*aggs)
    dmcase = (F.when(F.col("__event").isNotNull(), F.col("__event"))
              .when(F.col("__last") < N_VISITS, F.lit(20) - F.col("__last"))
              .otherwise(F.lit(N_VISITS))).cast("double")
    status = (F.when(F.col("__first") == 1, F.lit(1.1))
              .when(F.col("__first") == 2, F.lit(1.2)))
    return wide.select(
        F.col("o_custkey").alias("RID"), dmcase.alias("DMCASE"), status.alias("DMSTATUS_SUB"),
        *[c for c in wide.columns if c.startswith(("V", "AS"))])


def _with_changes(names):
    return tuple(x for n in names for x in (n, f"{n}_diff"))


# Feature groups of the event stand-in, shaped like the study's blocks.
EVENT_BLOCKS = {
    "activity": _with_changes(("click", "view", "signup", "active")),
    "spend": _with_changes(("purchase", "income", "tier", "error")),
}
# The same columns under the study's three block names, for the sweep over its five feature sets.
EVENT_STUDY_BLOCKS = {
    "bio": _with_changes(("purchase", "error")),
    "physical": _with_changes(("click", "view")),
    "life": _with_changes(("signup", "active", "income", "tier")),
}
EVENT_SET_DROPS = {"all": (), "activity": ("spend",), "spend": ("activity",)}
EVENT_SET_PCA = {"all": ("activity", "spend"), "activity": ("activity",), "spend": ("spend",)}
