"""Weekly scorecard aggregates, long metric rows, policy and projected score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark import functions as H
from haulmark.operators.columns import col
from haulmark.operators.reshape import long_metrics

__all__ = [
    "AGGREGATES", "LONG_METRICS", "POLICY_ROWS", "policy", "weekly_aggregates", "scorecard_long",
    "metric_scores", "projected_score", "projected_score_wide", "policy_by_name",
]

# Output column and the scorecard column it averages.
AGGREGATES = {
    "overall_score_avg": "overall_score",
    "speeding_event_rate_avg": "speeding_event_rate",
    "seatbelt_off_event_rate_avg": "seatbelt_off_rate",
    "sign_signal_violation_rate_avg": "sign_signal_viol_rate",
    "distraction_event_rate_avg": "distractions_rate",
    "following_distance_event_rate_avg": "following_dist_rate",
    "dcr_avg": "dcr_metric",
    "dsb_dpmo_avg": "dsb_metric",
    "pod_avg": "pod_metric",
    "cdf_dpmo_avg": "cdf_dpmo",
    "ced_dpmo_avg": "ced_metric",
    "psb_avg": "psb_metric",
}

# Metric names of the long form and the aggregate behind each. The
# last two have no source column and stay null.
LONG_METRICS = {
    "DSP Overall Average Safty Score": "overall_score_avg",
    "Speeding Event Rate": "speeding_event_rate_avg",
    "Seatbelt Off Event Rate": "seatbelt_off_event_rate_avg",
    "Sign/Signal Violation Rate": "sign_signal_violation_rate_avg",
    "Distraction Event Rate": "distraction_event_rate_avg",
    "Following Distance Event Rate": "following_distance_event_rate_avg",
    "Delivery Completion Rate %": "dcr_avg",
    "DSB DPMO": "dsb_dpmo_avg",
    "POD Success Rate": "pod_avg",
    "CDF DPMO": "cdf_dpmo_avg",
    "CED DPMO": "ced_dpmo_avg",
    "Tenured Workforce %": None,
    "Fleet Defect Rate": None,
}

# Metric code, weekly metric name, label, category, weight, direction,
# fantastic, great and fair thresholds. Weights total 104.8; scores divide by the total.
POLICY_ROWS = (
    ("DCR", "Delivery Completion Rate %", "Delivery Completion Rate %", "DeliveryQuality", "12.0", "H", "99.65", "99.00", "98.00"),
    ("DSB_DPMO", "DSB DPMO", "Delivery Success Behaviors DPMO", "DeliveryQuality", "12.0", "L", "50.0", "150.0", "400.0"),
    ("POD", "POD Success Rate", "Photo-On-Delivery Acceptance %", "DeliveryQuality", "3.0", "H", "98.0", "97.0", "95.0"),
    ("CDF_DPMO", "CDF DPMO", "Customer Delivery Feedback DPMO", "CustDeliveryExp", "6.0", "L", "1000.0", "3000.0", "8000.0"),
    ("CED_DPMO", "CED DPMO", "Customer Escalation Defect DPMO", "CustDeliveryExp", "12.0", "L", "10.0", "40.0", "100.0"),
    ("SPD_RATE", "Speeding Event Rate", "Speeding Event Rate per 100 trips", "Safety", "11.0", "L", "0.5", "1.5", "3.0"),
    ("SEAT_RATE", "Seatbelt Off Event Rate", "Seatbelt-Off Rate per 100 trips", "Safety", "11.0", "L", "0.5", "1.5", "3.0"),
    ("SSV_RATE", "Sign/Signal Violation Rate", "Sign/Signal Violations per 100 trips", "Safety", "11.0", "L", "0.5", "1.5", "3.0"),
    ("DIST_RATE", "Distraction Event Rate", "Distractions Rate per 100 trips", "Safety", "7.1", "L", "0.5", "1.5", "3.0"),
    ("FD_RATE", "Following Distance Event Rate", "Following Distance Rate per 100 trips", "Safety", "4.7", "L", "0.5", "1.5", "3.0"),
    ("TENURED", "Tenured Workforce %", "Tenured Workforce %", "TeamAndFleet", "5.0", "H", "90.0", "80.0", "70.0"),
    ("FLEET", "Fleet Defect Rate", "Fleet Execution Score (defect rate)", "TeamAndFleet", "5.0", "L", "0.0", "3.0", "10.0"),
    ("PSB", "Pickup Success Behaviors", "Pickup Success Behaviors defect rate", "Pickup", "5.0", "L", "0.0", "3.0", "10.0"),
)


def policy(spark: SparkSession, rows: Sequence[tuple] = POLICY_ROWS) -> DataFrame:
    """The policy table. A local relation: Spark knows its size and broadcasts it."""
    text = spark.createDataFrame(
        rows, "metric_code string, weekly_metric_name string, metric_name string, category string, "
              "weight string, direction string, fantastic string, great string, fair string")
    return text.select(
        "metric_code", "weekly_metric_name", "metric_name", "category",
        F.col("weight").cast("decimal(5,2)").alias("weight_overall_pct"), "direction",
        F.col("fantastic").cast("decimal(18,4)").alias("fantastic_threshold"),
        F.col("great").cast("decimal(18,4)").alias("great_threshold"),
        F.col("fair").cast("decimal(18,4)").alias("fair_threshold"),
        F.lit(0).cast("decimal(18,4)").alias("bias"),
        F.lit(1).cast("decimal(18,4)").alias("scale_factor"),
        F.lit(True).alias("is_active"), F.lit(False).alias("is_coming_soon"))


def weekly_aggregates(scorecard: DataFrame) -> DataFrame:
    """Drivers on route and metric averages per week label.

    Rows without an overall score were not on route. The label itself is the
    grouping key; the output shows the year and week read from it.
    """
    label = col("year_week_label")
    grouped = scorecard.filter(col("overall_score").isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("drivers_on_route"),
        *[F.avg(col(source)).alias(out) for out, source in AGGREGATES.items()])
    return grouped.select(
        H.label_year(label).alias("year"), H.label_week(label).alias("week"),
        "drivers_on_route", *AGGREGATES)


def scorecard_long(aggregates: DataFrame) -> DataFrame:
    """One row per week and metric, decimal(18,4)."""
    return long_metrics(aggregates, ["year", "week"], LONG_METRICS)


def _score(value: Column, direction: Column, fantastic: Column, great: Column, fair: Column) -> Column:
    return F.when(direction == "H", H.score_higher(value, fantastic, great, fair)).otherwise(
        H.score_lower(value, fantastic, great, fair))


def metric_scores(metrics: DataFrame, rules: DataFrame, by: str = "metric_code",
                  value: str = "metric_value") -> DataFrame:
    """Long metric rows joined to their policy row, with the band score."""
    return metrics.join(rules.drop(*[c for c in rules.columns if c in metrics.columns and c != by]), by).withColumn(
        "metric_score", _score(col(value), F.col("direction"), F.col("fantastic_threshold"),
                               F.col("great_threshold"), F.col("fair_threshold")))


def policy_by_name(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metric rows matched to the policy by the weekly metric name."""
    renamed = rules.drop("metric_name").withColumnRenamed("weekly_metric_name", "metric_name")
    return metric_scores(metrics, renamed, by="metric_name")


def _final(points: Column, weights: Column, breach: Column, compliant: Column) -> Column:
    score = (H.safe_divide(points, weights) * 100).cast("decimal(5,2)")
    zero = F.lit(0).cast("decimal(5,2)")
    return F.when((breach == 1) | (compliant == 0), zero).otherwise(score)


def projected_score(metrics: DataFrame, rules: DataFrame, unit: Sequence[str],
                    flags: DataFrame | None = None, active_only: bool = False) -> DataFrame:
    """Weighted score of 0 to 100 per unit from long metric rows (unit, metric_code, metric_value).

    A contract breach or failed compliance scores 0. A null metric, or one of the
    policy that the unit has no row of, makes the score null. Inactive metrics add to the points but not to the weights unless
    ``active_only``. The thirteen rows of a unit collapse on the map side, so the
    shuffle moves one row per unit and task.
    """
    if active_only:
        rules = rules.filter(F.col("is_active"))
    scored = metric_scores(metrics, rules)
    codes = rules.agg(F.count_distinct("metric_code")).scalar()
    weight = F.col("weight_overall_pct")
    sums = scored.groupBy(*[col(c) for c in unit]).agg(
        F.sum(weight * F.col("metric_score")).alias("__points"),
        F.sum(F.when(F.col("is_active"), weight).otherwise(0)).alias("__weights"),
        # at most as many codes as the policy has rows
        (F.every(F.col("metric_score").isNotNull()) & (F.size(F.collect_set("metric_code")) == codes)).alias("__whole"))
    if flags is None:
        breach, compliant = F.lit(0), F.lit(1)
    else:
        sums = sums.join(flags, list(unit), "left")
        breach = F.coalesce("breach_of_contract", F.lit(0))
        compliant = F.coalesce("cas_compliant", F.lit(1))
    points = F.when(F.col("__whole"), F.col("__points"))
    return sums.select(*[col(c) for c in unit], _final(
        points, F.col("__weights"), breach, compliant).alias("projected_overall_score_pct"))


def projected_score_wide(df: DataFrame, columns: Mapping[str, str],
                         rows: Sequence[tuple] = POLICY_ROWS, breach: Column | None = None,
                         compliant: Column | None = None) -> DataFrame:
    """The same score where the metrics are columns (policy code to column).

    With the policy as literals this is one projection: no join, no shuffle.
    """
    points, weights = F.lit(0).cast("decimal(21,6)"), F.lit(0).cast("decimal(15,2)")
    for code, _, _, _, weight, direction, *limits in rows:
        w = F.lit(weight).cast("decimal(5,2)")
        score = H.score_higher if direction == "H" else H.score_lower
        points = (points + w * score(col(columns[code]), *[F.lit(x) for x in limits])).cast("decimal(21,6)")
        weights = (weights + w).cast("decimal(15,2)")
    final = _final(points, weights, breach if breach is not None else F.lit(0),
                   compliant if compliant is not None else F.lit(1))
    return df.withColumn("projected_overall_score_pct", final)
