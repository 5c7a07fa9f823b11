"""Replenishment recommendations: exactly one action per risk row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import capitalise, percent, whole

# Engine parameters, rules, actions and texts of a recommendation.
ENGINE_VERSION = "1.0.0"
SAFETY_MARGIN = 0.10
PACK_SIZE = 5
ACTIONS = ["replenish_now", "replenish_scheduled", "investigate_data", "monitor"]
RULES = {
    # tier: (action, rule, priority)
    "HIGH": ("replenish_now", "R1_high_risk_replenish", 1),
    "MEDIUM": ("replenish_scheduled", "R2_medium_risk_schedule", 2),
    "LOW": ("monitor", "R3_monitor", 4),
}
UNKNOWN_TIER = ("monitor", "R0_unknown_tier", 4)
DATA_GAP = ("investigate_data", "R4_availability_data_gap", 3)
GAP_TEXT = (
    "Availability telemetry missing for series %s; no scarcity signal can be computed. "
    "Fix the data feed before committing stock decisions."
)
TIER_TEXT = (
    "Tier %s: forecast %s units over the horizon at %s observed availability; "
    "assuming future availability equals recent, ~%s units would go unmet. "
    "%s: recommend %s units (+%s safety margin, packed in %ss)."
)
UNKNOWN_TEXT = "Unrecognized risk tier '%s'; defaulted to monitoring."
GAP_ASSUMPTION = "ASSUMED: absent telemetry treated as fully available (inherited from the risk engine)"
AVAILABILITY_ASSUMPTION = "ASSUMED: future availability = recent observed (%s)"
MARGIN_ASSUMPTION = "ASSUMED: safety margin %s, pack size %s"
ASSUMPTION_SEPARATOR = " | "

REQUIRED = [
    "unique_id", "name", "warehouse", "risk_tier", "forecast_units", "recent_availability",
    "assumed_future_availability", "estimated_unmet_units", "risk_fraction", "availability_data_gap",
]


class ContractViolation(ValueError):
    """The risk table lacks columns the recommendations need."""


def check_contract(risk: DataFrame) -> None:
    missing = [c for c in REQUIRED if c not in risk.columns]
    if missing:
        raise ContractViolation(f"risk table lacks columns {missing}")


def order_quantity(unmet: Column) -> Column:
    """Unmet units plus the safety margin, in whole packs.

    Double arithmetic in this order: a product just above a pack boundary
    takes the next pack.
    """
    needed = F.greatest(unmet, F.lit(0.0)) * (F.lit(1.0) + F.lit(SAFETY_MARGIN))
    return F.ceil(needed / F.lit(float(PACK_SIZE))) * F.lit(PACK_SIZE).cast("long")


def _by_tier(tier: Column, part: int, unknown) -> Column:
    (first, rule), *rest = RULES.items()
    choice = F.when(tier == first, F.lit(rule[part]))
    for name, rule in rest:
        choice = choice.when(tier == name, F.lit(rule[part]))
    return choice.otherwise(unknown)


def recommendations(risk: DataFrame) -> DataFrame:
    """Action, quantity, rule and rationale of each risk row."""
    check_contract(risk)
    tier = F.col("risk_tier")
    known = F.coalesce(tier.isin(*RULES), F.lit(False))
    gap = F.coalesce("availability_data_gap", F.lit(False)) | F.col("assumed_future_availability").isNull()
    unmet = F.greatest(F.coalesce("estimated_unmet_units", F.lit(0.0)), F.lit(0.0))
    orders = ~gap & F.coalesce(tier.isin("HIGH", "MEDIUM"), F.lit(False))

    decided = risk.select(
        "unique_id",
        "name",
        "warehouse",
        "risk_tier",
        F.when(gap, DATA_GAP[0]).otherwise(_by_tier(tier, 0, F.lit(UNKNOWN_TIER[0]))).alias("action"),
        F.when(orders, order_quantity(unmet)).otherwise(F.lit(0).cast("long")).alias("recommended_units"),
        unmet.alias("estimated_unmet_units"),
        _by_tier(tier, 2, F.when(gap, DATA_GAP[2]).otherwise(UNKNOWN_TIER[2])).alias("priority"),
        F.when(gap, DATA_GAP[1]).otherwise(_by_tier(tier, 1, F.lit(UNKNOWN_TIER[1]))).alias("rule_id"),
        F.lit(ENGINE_VERSION).alias("engine_version"),
        "forecast_units",
        "recent_availability",
        "assumed_future_availability",
        gap.alias("gap"),
        known.alias("known"),
    )
    margin = percent(F.lit(SAFETY_MARGIN))
    rationale = (
        F.when(F.col("gap"), F.format_string(GAP_TEXT, F.col("unique_id").cast("string")))
        .when(
            F.col("known"),
            F.format_string(
                TIER_TEXT,
                tier,
                whole(F.col("forecast_units")),
                percent(F.col("recent_availability")),
                whole(F.col("estimated_unmet_units")),
                capitalise(F.col("action")),
                F.col("recommended_units").cast("string"),
                margin,
                F.lit(str(PACK_SIZE)),
            ),
        )
        .otherwise(F.format_string(UNKNOWN_TEXT, F.coalesce(tier, F.lit("nan"))))
    )
    assumptions = (
        F.when(F.col("gap"), F.lit(GAP_ASSUMPTION))
        .when(
            F.col("known"),
            F.concat_ws(
                ASSUMPTION_SEPARATOR,
                F.format_string(AVAILABILITY_ASSUMPTION, percent(F.col("assumed_future_availability"))),
                F.format_string(MARGIN_ASSUMPTION, margin, F.lit(str(PACK_SIZE))),
            ),
        )
        .otherwise(F.lit(""))
    )
    return (
        decided.withColumn("rationale", rationale)
        .withColumn("assumptions", assumptions)
        .drop("forecast_units", "recent_availability", "assumed_future_availability", "gap", "known")
    )


def by_priority(recs: DataFrame) -> DataFrame:
    return recs.orderBy("priority", F.desc_nulls_last("estimated_unmet_units"), "unique_id")


def coverage(risk: DataFrame, recs: DataFrame) -> DataFrame:
    """Input rows, output rows and rows with a valid action; all three agree."""
    valid = recs.agg(
        F.struct(
            F.count(F.lit(1)).alias("n_out"), F.count_if(F.col("action").isin(*ACTIONS)).alias("n_valid")
        )
    ).scalar()
    return (
        risk.agg(F.count(F.lit(1)).alias("risk_rows"))
        .withColumn("out", valid)
        .select(
            "risk_rows",
            F.col("out.n_out").alias("recommendation_rows"),
            F.col("out.n_valid").alias("valid_action_rows"),
        )
    )
