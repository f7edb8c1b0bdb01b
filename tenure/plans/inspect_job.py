"""Model inspection jobs: metrics, top coefficients, hypothetical profiles,
their scores and directional checks, as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import INSPECT_SURVIVAL_TIMES
from tenure.operators import cox, features, logistic, scoring, survival
from tenure.plans.cox_job import CoxRun
from tenure.plans.logistic_job import LogisticRun


@dataclass
class Inspection:
    top_positive: DataFrame
    top_negative: DataFrame
    profiles: DataFrame
    scores: DataFrame
    checks: DataFrame


def inspect_logistic(run: LogisticRun, top_n: int = 10) -> Inspection:
    """Baseline = per-feature median of the training split; the fixed
    scenarios; probabilities ranked; expectations from coefficient signs."""
    spark = run.training.sparkSession
    coefs = run.model.coefficient_frame(spark)
    top, bottom = logistic.top_positive_negative(coefs.drop("abs_coefficient"), "coefficient", top_n)
    kept = run.selection.kept_columns
    profiles = scoring.scenario_profiles_logistic(scoring.baseline_median_profile(run.train, kept), kept)
    scored = logistic.predict_logistic(profiles, run.model, prob_col="predicted_survival_probability")
    related = scoring.relation_to_baseline(scored, "predicted_survival_probability")
    checks = scoring.directional_check(related, coefs, "coefficient", "above_baseline", "below_baseline", "same_as_baseline")
    ranked = related.select("profile", "predicted_survival_probability", "predicted_label", "actual_vs_baseline").orderBy(
        F.desc("predicted_survival_probability"), "profile"
    )
    return Inspection(top, bottom, profiles, ranked, checks)


def inspect_cox(run: CoxRun, panel: DataFrame, study_end, active_license_override: int = 3, strict: bool = False) -> Inspection:
    """Baseline = first panel row; category and multi-licence scenarios;
    partial hazard (and survival at 12/24/36/60/120 months for the standard
    model); expectations from coefficient signs.  ``strict`` raises when a
    required scenario feature is missing or an expectation fails."""
    spark = panel.sparkSession
    kept = run.selection.kept_columns
    summary = cox.summary_frame(spark, run.model)
    top, bottom = logistic.top_positive_negative(summary.select("feature", "coef"), "coef", 10)
    if strict:
        required = spark.createDataFrame([(f,) for _, f in scoring.COX_CATEGORY_SCENARIOS], "feature string")
        missing = [r.feature for r in scoring.check_features_available(
            spark.createDataFrame([(c,) for c in kept], "feature string"), required).collect()]
        if missing:
            raise ValueError(f"Required features were not kept by the model: {missing}")
    base = scoring.baseline_first_row(survival.restrict_study_window(panel, study_end), kept)
    profiles = scoring.scenario_profiles_cox(base, kept, active_license_override)
    scored = cox.partial_hazard(features.standardize(profiles, run.scaler, keep=["profile", "scenario_feature"]), run.model)
    if run.model.baseline is not None:
        scored = cox.survival_at(scored, run.model, INSPECT_SURVIVAL_TIMES)
    related = scoring.relation_to_baseline(scored, "partial_hazard", "higher_risk", "lower_risk", "same_risk")
    checks = scoring.directional_check(related, summary, "coef", "higher_risk", "lower_risk", "same_risk")
    if strict and checks.where(~F.col("matches_expectation")).limit(1).count():
        raise ValueError("Directional expectations failed for the Cox model.")
    return Inspection(top, bottom, profiles, related, checks)
