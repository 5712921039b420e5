"""Scores from weighted percentiles: slots, dimensions, confidence, shrinkage, risk and grades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The weights of the seven dimensions.
WEIGHTS = {"G": 0.18, "V": 0.18, "M": 0.18, "EQ": 0.12, "FS": 0.08, "CA": 0.16, "T": 0.10}
#: Each dimension's slots and their weights inside it.
SLOTS = {
    "G": (("operating_profit_per_share_cagr_3y", 0.35), ("operating_profit_per_share_yoy", 0.25), ("operating_revenue_cagr_3y", 0.25), ("operating_revenue_yoy", 0.15)),
    "V": (("normalized_earnings_yield", 0.45), ("normalized_free_cash_flow_yield", 0.25), ("enterprise_value_or_sustainable_roe", 0.30)),
    "M": (("return_persistence", 0.40), ("margin_persistence", 0.30), ("cash_conversion_or_asset_efficiency", 0.30)),
    "EQ": (("cash_flow_to_operating_profit", 0.35), ("accrual_quality", 0.25), ("core_profit_share", 0.20), ("working_capital_quality", 0.20)),
    "FS": (("leverage_or_regulatory_capital", 0.40), ("liquidity_or_interest_coverage", 0.35), ("asset_or_contingent_risk", 0.25)),
    "CA": (("return_persistence", 0.35), ("incremental_capital_return", 0.30), ("shareholder_return_and_dilution", 0.20), ("capital_discipline", 0.15)),
    "T": (("historical_valuation", 0.35), ("price_trend_and_volatility", 0.25), ("expectation_change", 0.25), ("quantified_event_and_liquidity", 0.15)),
}
#: The slots that the risk score reads by themselves.
RISK_SLOTS = ("M.return_persistence", "M.margin_persistence", "CA.shareholder_return_and_dilution", "CA.capital_discipline")


def dimension_scores(slots: DataFrame, key: list[str], dimension: str, weight: str, value: str) -> DataFrame:
    """score and weight sum for each key and dimension; a missing value makes the dimension null, never zero."""
    out = slots.groupBy(*key, dimension).agg(F.sum(F.col(weight) * F.col(value)).alias("_s"), F.sum(weight).alias("weight"), F.count_if(F.col(value).isNull()).alias("absent"))
    sound = (F.col("absent") == 0) & (F.abs(F.col("weight") - 1) < 1e-9)
    return out.withColumn("score", F.when(sound, F.col("_s"))).drop("_s")


def spread(scores: DataFrame, key: list[str], dimension: str, value: str, names: list[str]) -> DataFrame:
    """One row a key, a column a dimension."""
    return scores.groupBy(*key).agg(*(F.max(F.when(F.col(dimension) == n, F.col(value))).alias(n) for n in names))


def weighted(values: dict[str, Column], weights: dict[str, float]) -> Column:
    """Sum of weight times value; null if a value is null."""
    return reduce(lambda a, b: a + b, (values[n] * w for n, w in weights.items()))


def arithmetic(values: dict[str, Column], confidence: Column, risk: dict[str, Column], weights: dict[str, float] | None = None) -> dict[str, Column]:
    """The score's numbers from the dimensions, the confidence and the slots of ``RISK_SLOTS``.

    S0 is the whole score and Sbase that without T; Sc and B are the two shrunk towards 50. R_safety is
    higher for safer ones and risk_exposure what is left to 100.
    """
    w = weights or WEIGHTS
    whole = weighted(values, w)
    rest = {n: v for n, v in w.items() if n != "T"}
    base = weighted(values, rest) / F.lit(0.90 if weights is None else sum(rest.values()))
    persistence = (0.40 * risk[RISK_SLOTS[0]] + 0.30 * risk[RISK_SLOTS[1]]) / F.lit(0.70)
    downside = (0.20 * risk[RISK_SLOTS[2]] + 0.15 * risk[RISK_SLOTS[3]]) / F.lit(0.35)
    safety = 0.40 * values["FS"] + 0.25 * values["EQ"] + 0.20 * persistence + 0.15 * downside
    return {"S0": whole, "Sc": 50 + confidence * (whole - 50), "Sbase": base, "B": 50 + confidence * (base - 50), "M_persistence": persistence, "CA_downside": downside, "R_safety": safety, "risk_exposure": 100 - safety}


def confidence(quality: Column, years: Column, cap: Column | None = None) -> dict[str, Column]:
    """D, P, H, K and C: complete data, ``quality`` of its timing, continuous fiscal ``years`` of five, one mapping; ``cap`` comes last and may be null."""
    history = F.least(years / F.lit(5.0), F.lit(1.0))
    c = F.lit(0.60) + F.lit(0.40) * (F.lit(0.30) + 0.25 * quality + 0.25 * history + F.lit(0.20))
    held = c if cap is None else F.when(c.isNotNull(), F.least(c, F.coalesce(cap, F.lit(1.0))))
    return {"D": F.lit(1.0), "P": quality, "H": history, "K": F.lit(1.0), "C": held}


def capped(scores: DataFrame, caps: DataFrame, key: list[str], dimension: str = "dimension") -> DataFrame:
    """Scores with each dimension's lowest cap put on."""
    lowest = caps.groupBy(*key, dimension).agg(F.min("cap").alias("cap"))
    return scores.join(lowest, [*key, dimension], "left").withColumn("capped", F.when(F.col("score").isNotNull(), F.least("score", F.coalesce("cap", F.lit(100.0)))))


def evidence_quality(precision: Column) -> Column:
    """1 for a timestamp, 0.8 for a bare date."""
    return F.when(precision == "timestamp", 1.0).when(precision == "date_only", 0.8)


def temporal_quality(evidence: DataFrame, key: list[str], precision: str) -> DataFrame:
    """The worst quality of each key's evidence; null if some of it has another precision."""
    q = evidence_quality(F.col(precision))
    return evidence.groupBy(*key).agg(F.when(F.count(q) == F.count(F.lit(1)), F.min(q)).alias("quality"))


def present_share(names: list[str]) -> Column:
    """The share of the columns that are there."""
    return reduce(lambda a, b: a + b, (F.col(n).isNotNull().cast("int") for n in names)) / F.lit(float(len(names)))


def consensus_branch(linked: Column, status: Column, no_coverage: Column, estimates: Column) -> Column:
    """unlinked, absent (a link without a fact), neutral (nobody covers it), covered or malformed."""
    neutral = no_coverage & (status == "no_valid_coverage") & (estimates == 0)
    covered = ~no_coverage & (status == "covered") & (estimates > 0)
    return F.when(~linked, "unlinked").when(status.isNull(), "absent").when(F.coalesce(neutral, F.lit(False)), "neutral").when(F.coalesce(covered, F.lit(False)), "covered").otherwise("malformed")
