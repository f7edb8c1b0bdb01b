"""Registered queries: one callable per operator of the blueprint.

Each takes ``(spark, sf_dir)``, reads the driver's test tables through the
fixture adapter and returns a DataFrame; ``ORACLE`` holds the equivalent
DuckDB SQL where the operator is SQL-expressible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.config import CATEGORY_PREFIX, COMPLAINT_PREFIX, PanelSettings
from tenure.operators import cleaning, clustering, cox, evaluation, features, geojson, logistic, panel, sampling, scoring, spatial, survival
from tenure.operators import upsert as U
from tenure.plans import oracle as O
from tenure.sources import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Study end for the driver's tables (their licence dates run 1995..2003).
FIXTURE_STUDY_END = dt.date(2001, 1, 1)


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- inputs ----
_MEMO: dict = {}


def _memo(key, spark, build):
    """Per-application memo for expensive shared steps (KMeans, model fits).
    Keyed by the Spark application id, so a new context never sees frames
    bound to a stopped one."""
    sc = spark.sparkContext
    full = (sc.applicationId, sc.startTime, key)
    if full not in _MEMO:
        _MEMO[full] = build()
    return _MEMO[full]


def _full_panel(spark, sf):
    """The complete panel (KMeans clusters included), built once per session
    and saved by business in the shared checkpoint folder."""
    from tenure.plans.panel import saved_panel

    return _memo(("panel", sf), spark, lambda: saved_panel(fixtures.licenses(spark, sf), fixtures.requests(spark, sf)))


def _licenses(spark, sf):
    return cleaning.clean_licenses(fixtures.licenses(spark, sf))


def _requests(spark, sf):
    return cleaning.clean_service_requests(fixtures.requests(spark, sf))


def _locations(spark, sf):
    return panel.business_locations(_licenses(spark, sf))


def _pairs(spark, sf):
    return spatial.radius_join(_locations(spark, sf), _requests(spark, sf), PanelSettings().radius_meters)


def _complaint_counts(spark, sf):
    """Long-form counts of requests around each business (no pairs of rows),
    built and checkpointed once per application."""
    from tenure.operators.sampling import _checkpoint

    def build():
        return _checkpoint(spatial.radius_counts(_locations(spark, sf), _requests(spark, sf), PanelSettings().radius_meters))

    return _memo(("complaint_counts", sf), spark, build)


def _fixed_panel(spark, sf):
    """The complete panel at fixed cluster centres, built once per session."""
    from tenure.operators.sampling import _saved
    from tenure.plans.panel import build_panel_parts

    def build():
        parts = build_panel_parts(fixtures.licenses(spark, sf), fixtures.requests(spark, sf), centres=O.FIXED_CENTRES)
        return _saved(parts.panel, "fixed-panel")

    return _memo(("fixed_panel", sf), spark, build)


def _panel_core(spark, sf):
    """The panel flow without KMeans (core columns only: cluster ids are
    arbitrary, so the oracle-checked queries derive from this), built and
    saved once per application, by business: its months are in one file."""
    from tenure.operators.sampling import _saved_by

    return _memo(("panel_core", sf), spark, lambda: _saved_by(*_build_panel_core(spark, sf)))


def _build_panel_core(spark, sf):
    from tenure.operators.sampling import _checkpoint
    from tenure.plans.panel import complaint_months

    lic = _licenses(spark, sf)
    cats = panel.feature_dictionary(lic, "business_category", CATEGORY_PREFIX)
    counts = panel.license_month_counts_by_business(lic, cats)
    facts = _checkpoint(panel.business_facts(lic).where(F.col("business_latitude").isNotNull()))
    sites = spatial.BusinessSites(facts, PanelSettings().radius_meters)
    cmps, complaints = complaint_months(sites, _requests(spark, sf))
    located = (
        facts.withColumn("location_cluster", F.lit(0))
        .withColumn("location_cluster_lat", F.col("business_latitude"))
        .withColumn("location_cluster_lng", F.col("business_longitude"))
    )
    merged = panel.merge_panel_by_business(counts, complaints, located, cats, cmps)
    core = merged.drop("location_cluster", "location_cluster_lat", "location_cluster_lng")
    return core, "panel-core", "business_id", counts.tasks


# --------------------------------------------------------- 2.3 cleaning ----
@query(
    "clean_licenses",
    O.with_ctes("lic") + "select business_id, license_number, business_category, license_status, issue_date,"
    " expire_date, latitude, longitude, issue_month, expire_month from lic",
)
def q_clean_licenses(spark, sf):
    return _licenses(spark, sf)


@query(
    "clean_service_requests",
    O.with_ctes("req") + "select unique_key, complaint_type, created_date, latitude, longitude, month from req",
)
def q_clean_service_requests(spark, sf):
    return _requests(spark, sf)


# -------------------------------------------------------- 2.4 reshaping ----
@query(
    "month_range",
    O.with_ctes("lic") + "select cast(unnest(generate_series(cast(min(issue_month) as timestamp),"
    " cast(max(expire_month) as timestamp), interval 1 month)) as date) AS month from lic",
)
def q_month_range(spark, sf):
    """Every month between the first issue month and the last expiry month."""
    lic = _licenses(spark, sf)
    bounds = lic.agg(F.min("issue_month").alias("a"), F.max("expire_month").alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))


@query(
    "expand_to_months",
    O.with_ctes("exp") + "select business_id, license_number, business_category, month from exp",
)
def q_expand(spark, sf):
    return panel.expand_to_months(_licenses(spark, sf)).select("business_id", "license_number", "business_category", "month")


@query("feature_dictionary_categories", O.with_ctes("dict_cat") + "select raw, feature from dict_cat")
def q_dict_cat(spark, sf):
    return panel.feature_dictionary_frame(_licenses(spark, sf), "business_category", CATEGORY_PREFIX)


@query("feature_dictionary_complaints", O.with_ctes("dict_cmp") + "select raw, feature from dict_cmp")
def q_dict_cmp(spark, sf):
    return panel.feature_dictionary_frame(_complaint_counts(spark, sf), "complaint_type", COMPLAINT_PREFIX)


@query(
    "pivot_categories",
    O.with_ctes("lcounts") + "select business_id, month, " + ", ".join(O.CAT_COLS) + " from lcounts",
)
def q_pivot_categories(spark, sf):
    lic = _licenses(spark, sf)
    cats = panel.feature_dictionary(lic, "business_category", CATEGORY_PREFIX)
    return panel.license_month_counts(panel.expand_to_months(lic), cats).drop("active_license_count")


@query(
    "pivot_complaints",
    O.with_ctes("ccounts") + "select business_id, month, " + ", ".join(O.CMP_COLS) + " from ccounts",
)
def q_pivot_complaints(spark, sf):
    long = _complaint_counts(spark, sf)
    cmps = panel.feature_dictionary(long, "complaint_type", COMPLAINT_PREFIX)
    return panel.complaint_panel_from_long(long, cmps).drop("total_311")


# ------------------------------------------------------ 2.6 aggregates ----
@query(
    "first_license_date",
    O.with_ctes("lic") + "select business_id, min(issue_date) first_license_date from lic group by business_id",
)
def q_first_license_date(spark, sf):
    return _licenses(spark, sf).groupBy("business_id").agg(F.min("issue_date").alias("first_license_date"))


@query(
    "active_license_count",
    O.with_ctes("exp") + "select business_id, month, count(distinct license_number) active_license_count from exp group by all",
)
def q_active_license_count(spark, sf):
    return (
        panel.expand_to_months(_licenses(spark, sf))
        .groupBy("business_id", "month")
        .agg(F.countDistinct("license_number").alias("active_license_count"))
    )


@query(
    "category_month_counts",
    O.with_ctes("exp") + "select business_id, month, business_category, count(license_number) n from exp group by all",
)
def q_category_month_counts(spark, sf):
    return (
        panel.expand_to_months(_licenses(spark, sf))
        .groupBy("business_id", "month", "business_category")
        .agg(F.count("license_number").alias("n"))
    )


@query(
    "license_panel",
    O.with_ctes("lcounts") + "select lc.*, cast((year(lc.month)-year(f.first_license_date))*12"
    " + month(lc.month)-month(f.first_license_date) as integer) months_since_first_license, 1 open"
    " from lcounts lc join facts f on lc.business_id = f.business_id",
)
def q_license_panel(spark, sf):
    out, _ = panel.license_panel(_licenses(spark, sf))
    return out.withColumn("months_since_first_license", F.col("months_since_first_license").cast("int"))


@query("business_locations", O.with_ctes("loc") + "select * from loc")
def q_business_locations(spark, sf):
    return _locations(spark, sf)


@query(
    "complaint_totals",
    O.with_ctes("pairs") + "select business_id, month, count(unique_key) total_311 from pairs group by all",
)
def q_complaint_totals(spark, sf):
    return _complaint_counts(spark, sf).groupBy("business_id", "month").agg(F.sum("n").alias("total_311"))


@query(
    "complaint_type_counts",
    O.with_ctes("pairs") + "select business_id, month, complaint_type, count(unique_key) n from pairs group by all",
)
def q_complaint_type_counts(spark, sf):
    return _complaint_counts(spark, sf)


@query("complaint_panel", O.with_ctes("ccounts") + "select * from ccounts")
def q_complaint_panel(spark, sf):
    """Long-form counts of the radius pairs, pivoted last."""
    long = _complaint_counts(spark, sf)
    return panel.complaint_panel_from_long(long, panel.feature_dictionary(long, "complaint_type", COMPLAINT_PREFIX))


# ------------------------------------------------------------ 2.5 joins ----
@query("radius_join", O.with_ctes("pairs") + "select * from pairs")
def q_radius_join(spark, sf):
    return _pairs(spark, sf)


@query("merge_panel", O.with_ctes("panel_core") + "select * from panel_core")
def q_merge_panel(spark, sf):
    """Full panel flow except the cluster columns (KMeans ids are arbitrary)."""
    return _panel_core(spark, sf)


@query(
    "row_sums",
    O.with_ctes("panel_core") + "select business_id, month, business_category_sum, complaint_sum from panel_core",
)
def q_row_sums(spark, sf):
    return _panel_core(spark, sf).select("business_id", "month", "business_category_sum", "complaint_sum")


@query(
    "validate_panel",
    O.with_ctes("panel_core") + "select cast(coalesce(sum(n) filter (where month is null), 0) as bigint) null_months,"
    " cast(count(*) filter (where n > 1) as bigint) duplicate_keys from (select business_id, month, count(*) n"
    " from panel_core group by all) t",
)
def q_validate_panel(spark, sf):
    core = _panel_core(spark, sf)
    for c in ("location_cluster", "location_cluster_lat", "location_cluster_lng"):
        core = core.withColumn(c, F.lit(0))
    return cleaning.panel_violations(core)


# ------------------------------------------------- 2.12 / 2.6 flagship ----
@query("kmeans_locations")
def q_kmeans(spark, sf):
    """Located businesses with their KMeans cluster (ids arbitrary: rows-only)."""
    locs = _locations(spark, sf)
    centres = clustering.fit_location_clusters(locs, PanelSettings().location_k, PanelSettings().kmeans_restarts)
    return clustering.assign_location_clusters(locs, centres)


@query("build_joined_dataset")
def q_build_joined(spark, sf):
    from tenure.plans.panel import build_panel

    return build_panel(fixtures.licenses(spark, sf), fixtures.requests(spark, sf))


# -------------------------------------------------- 2.6/2.7 survival sets ----
SURV_MONTHS, AGG_MONTHS = 36, 12


def _study_panel(spark, sf):
    return survival.restrict_study_window(_panel_core(spark, sf), FIXTURE_STUDY_END)


@query("restrict_study_window", O.with_ctes("pc") + "select * from pc")
def q_restrict(spark, sf):
    return _study_panel(spark, sf)


@query("survival_summary", O.with_ctes("surv") + "select * from surv")
def q_survival_summary(spark, sf):
    return survival.survival_summary(_study_panel(spark, sf), SURV_MONTHS)


@query("eligible_businesses", O.with_ctes("elig") + "select * from elig")
def q_eligible(spark, sf):
    s = survival.survival_summary(_study_panel(spark, sf), SURV_MONTHS)
    return survival.eligible_businesses(s, FIXTURE_STUDY_END, SURV_MONTHS, AGG_MONTHS)


@query("first_year_window", O.with_ctes("fyw") + "select * from fyw")
def q_first_year_window(spark, sf):
    p = _study_panel(spark, sf)
    e = survival.eligible_businesses(survival.survival_summary(p, SURV_MONTHS), FIXTURE_STUDY_END, SURV_MONTHS, AGG_MONTHS)
    return survival.first_year_window(p.join(e.select("business_id"), "business_id", "left_semi"), AGG_MONTHS)


@query("first_year_aggregate", O.with_ctes("fya") + "select * from fya")
def q_first_year_aggregate(spark, sf):
    p = _study_panel(spark, sf)
    e = survival.eligible_businesses(survival.survival_summary(p, SURV_MONTHS), FIXTURE_STUDY_END, SURV_MONTHS, AGG_MONTHS)
    return survival.first_year_aggregate(p.join(e.select("business_id"), "business_id", "left_semi"), AGG_MONTHS)


@query("training_dataset", O.with_ctes("train") + "select * from train")
def q_training_dataset(spark, sf):
    return survival.training_dataset(_study_panel(spark, sf), FIXTURE_STUDY_END, SURV_MONTHS, AGG_MONTHS)


@query("time_varying_panel", O.with_ctes("pc") + O.TV_SQL)
def q_time_varying(spark, sf):
    return survival.time_varying_panel(_panel_core(spark, sf), FIXTURE_STUDY_END)


@query("business_level_dataset", O.with_ctes("pc") + O.BL_SQL)
def q_business_level(spark, sf):
    return survival.business_level_dataset(_panel_core(spark, sf), FIXTURE_STUDY_END)


# ------------------------------------------------------ 2.12 logistic ----
def _training(spark, sf):
    return survival.training_dataset(_study_panel(spark, sf), FIXTURE_STUDY_END, SURV_MONTHS, AGG_MONTHS)


def _logit_features(training):
    from tenure.config import LOGISTIC_EXCLUDED

    return features.feature_columns(training.columns, LOGISTIC_EXCLUDED)


@query(
    "split_features_target",
    O.with_ctes("train") + "select business_id, " + ", ".join(O.LOGIT_FEATURES) + ", survived_36m from train",
)
def q_split_features(spark, sf):
    t = _training(spark, sf)
    return t.select("business_id", *_logit_features(t), "survived_36m")


@query(
    "variance_filter",
    O.with_ctes("train") + "select " + ", ".join(f"var_pop(cast({c} as double)) {c}" for c in O.LOGIT_FEATURES) + " from train",
)
def q_variance_filter(spark, sf):
    """Population variance of every candidate feature over its non-null
    values (kept iff > 1e-8)."""
    t = _training(spark, sf)
    return features.variances(t, _logit_features(t))


@query(
    "standardize",
    O.with_ctes("train") + "select business_id, "
    + ", ".join(
        f"(coalesce({c},0) - avg(coalesce({c},0)) over ()) / case when stddev_pop(coalesce({c},0)) over () > 2.220446049250313e-15"
        f" * greatest(1.0, abs(avg(coalesce({c},0)) over ())) then stddev_pop(coalesce({c},0)) over () else 1.0 end {c}"
        for c in O.LOGIT_FEATURES
    )
    + " from train",
)
def q_standardize(spark, sf):
    t = _training(spark, sf)
    cols = _logit_features(t)
    return features.standardize(t, features.fit_scaler(t, cols), keep=["business_id"])


@query(
    "impute_zero",
    O.with_ctes("train") + "select business_id, " + ", ".join(f"coalesce({c}, 0) {c}" for c in O.LOGIT_FEATURES) + " from train",
)
def q_impute_zero(spark, sf):
    t = _training(spark, sf)
    cols = _logit_features(t)
    return t.select("business_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in cols])


@query(
    "class_balance_counts",
    O.with_ctes("train") + "select survived_36m, count(*) n from train group by survived_36m",
)
def q_class_balance(spark, sf):
    return _training(spark, sf).groupBy("survived_36m").agg(F.count(F.lit(1)).alias("n"))


def _eval_scored(spark, sf):
    a = F.col("active_license_count_first12m_mean")
    p = a / (F.lit(1.0) + a)
    return _training(spark, sf).select(
        F.col("survived_36m"), p.alias("probability"), (p > 0.5).cast("int").alias("predicted_label")
    )


@query("evaluate_classifier", O.with_ctes("train") + O.EVAL_SQL)
def q_evaluate(spark, sf):
    """Exact metrics of a score column (here first-year licence-count score)."""
    return evaluation.evaluate_classifier(_eval_scored(spark, sf), "survived_36m", "probability", "predicted_label")


@query("class_metrics", O.with_ctes("train") + O.CLASS_METRICS_SQL)
def q_class_metrics(spark, sf):
    return evaluation.class_metrics(evaluation.confusion_counts(_eval_scored(spark, sf), "survived_36m", "predicted_label"))


@query("balance_oversample", O.with_ctes("train") + O.BALANCE_SQL)
def q_balance(spark, sf):
    t = _training(spark, sf)
    data = t.select("business_id", *_logit_features(t), "survived_36m")
    return sampling.balance_oversample(data, "survived_36m", ["business_id"], 42)


@query("stratified_split", O.with_ctes("train") + O.SPLIT_SQL)
def q_split(spark, sf):
    t = _training(spark, sf)
    data = t.select("business_id", *_logit_features(t), "survived_36m").withColumn("_copy", F.lit(-1).cast("long"))
    train, test = sampling.stratified_split(data, "survived_36m", ["business_id", "_copy"], 0.2, 42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def _logistic_run(spark, sf):
    from tenure.config import ModelSettings
    from tenure.plans.logistic_job import run_logistic

    return _memo(("logistic", sf), spark, lambda: run_logistic(_full_panel(spark, sf), ModelSettings(study_end=FIXTURE_STUDY_END)))


@query("logistic_pipeline")
def q_logistic(spark, sf):
    """Coefficient table of the fitted L2 logistic model (ranked by |coef|)."""
    run = _logistic_run(spark, sf)
    return run.model.coefficient_frame(spark)


@query("predict_logistic")
def q_predict_logistic(spark, sf):
    run = _logistic_run(spark, sf)
    return run.scored.select("business_id", "_copy", "survived_36m", "probability", "predicted_label")


@query("top_positive_negative")
def q_top_pos_neg(spark, sf):
    run = _logistic_run(spark, sf)
    top, bottom = logistic.top_positive_negative(run.model.coefficient_frame(spark).drop("abs_coefficient"), "coefficient", 10)
    return top.withColumn("side", F.lit("positive")).unionByName(bottom.withColumn("side", F.lit("negative")))


# ----------------------------------------------------------- 2.12 cox ----
@query("cox_prepare_std", O.with_ctes("pc") + O.COX_STD_SQL)
def q_cox_prepare_std(spark, sf):
    from tenure.config import ModelSettings
    from tenure.plans.cox_job import prepare_business_level

    modeling, _, _ = prepare_business_level(_panel_core(spark, sf), ModelSettings(study_end=FIXTURE_STUDY_END))
    return modeling


@query("cox_prepare_tv", O.with_ctes("pc") + O.COX_TV_SQL)
def q_cox_prepare_tv(spark, sf):
    from tenure.config import ModelSettings
    from tenure.plans.cox_job import prepare_time_varying

    modeling, _, _ = prepare_time_varying(_study_panel(spark, sf), ModelSettings(study_end=FIXTURE_STUDY_END))
    return modeling


@query("cox_risk_set_stats", O.with_ctes("pc") + O.RISK_SET_SQL)
def q_cox_risk_sets(spark, sf):
    """Events, rows at risk and the fit's sums S0, S1 at fixed coefficients,
    per event time of both models."""
    core = _panel_core(spark, sf)
    bl = survival.business_level_dataset(core, FIXTURE_STUDY_END)
    tv = survival.time_varying_panel(core, FIXTURE_STUDY_END)
    out = None
    for kind, data, span in (("standard", bl, ("duration_months", "event")), ("time_varying", tv, ("stop", "event", "start"))):
        sums = cox.risk_set_sums(data, O.RISK_BETA, *span)
        counts = cox.risk_set_sums(data, {}, *span).select("time", F.col("s0").cast("long").alias("n_at_risk"))
        both = sums.join(counts, "time").select(
            F.lit(kind).alias("model"), F.col("time").cast("int").alias("time"), "n_events", "n_at_risk", "s0", *[f"s1_{c}" for c in O.RISK_BETA]
        )
        out = both if out is None else out.unionByName(both)
    return out


def _cox_runs(spark, sf):
    from tenure.config import ModelSettings
    from tenure.plans.cox_job import run_cox

    return _memo(("cox", sf), spark, lambda: run_cox(_full_panel(spark, sf), ModelSettings(study_end=FIXTURE_STUDY_END)))


@query("cox_fit_standard")
def q_cox_standard(spark, sf):
    """Coefficient summary of the penalised standard Cox model."""
    return cox.summary_frame(spark, _cox_runs(spark, sf)["standard"].model)


@query("cox_fit_time_varying")
def q_cox_tv(spark, sf):
    """Coefficient summary of the penalised time-varying Cox model."""
    return cox.summary_frame(spark, _cox_runs(spark, sf)["time_varying"].model)


@query("cox_predict_hazard")
def q_cox_hazard(spark, sf):
    """Partial hazard of every business-month under the time-varying model."""
    run = _cox_runs(spark, sf)["time_varying"]
    return cox.partial_hazard(run.modeling, run.model).select("business_id", "month", "partial_hazard")


@query("cox_predict_survival")
def q_cox_survival(spark, sf):
    """Survival at 12/36/60/120 months for every business (standard model)."""
    from tenure.config import COX_SURVIVAL_TIMES

    run = _cox_runs(spark, sf)["standard"]
    scored = cox.partial_hazard(run.modeling, run.model)
    return cox.survival_at(scored, run.model, COX_SURVIVAL_TIMES).select(
        "business_id", "partial_hazard", *[f"survival_prob_{t}m" for t in COX_SURVIVAL_TIMES]
    )


# ------------------------------------------------------- 2.12 profiles ----
@query("baseline_median_profile", O.with_ctes("train") + O.BASELINE_MEDIAN_SQL)
def q_baseline_median(spark, sf):
    t = _training(spark, sf)
    return scoring.baseline_median_profile(t, _logit_features(t))


@query("scenario_profiles_logistic", O.with_ctes("train") + O.SCEN_LOGIT_SQL)
def q_scen_logit(spark, sf):
    t = _training(spark, sf)
    kept = _logit_features(t)
    return scoring.scenario_profiles_logistic(scoring.baseline_median_profile(t, kept), kept)


@query("unpivot_nonzero_features", O.with_ctes("train") + O.UNPIVOT_SQL)
def q_unpivot(spark, sf):
    t = _training(spark, sf)
    kept = _logit_features(t)
    prof = scoring.scenario_profiles_logistic(scoring.baseline_median_profile(t, kept), kept)
    return scoring.unpivot_nonzero_features(prof.drop("scenario_feature"), "profile", kept)


def _bl_features():
    return [c for c in O.BL_FEATURES]


@query("baseline_first_row", O.with_ctes("pc") + O.FIRST_ROW_SQL)
def q_baseline_first_row(spark, sf):
    return scoring.baseline_first_row(_study_panel(spark, sf), _bl_features())


@query("scenario_profiles_cox", O.with_ctes("pc") + O.SCEN_COX_SQL)
def q_scen_cox(spark, sf):
    base = scoring.baseline_first_row(_study_panel(spark, sf), _bl_features())
    return scoring.scenario_profiles_cox(base, _bl_features(), 3)


@query(
    "reference_median",
    O.with_ctes("pc") + "select coalesce(cast(median(business_latitude) as double), 40.7128) median_lat,"
    " coalesce(cast(median(business_longitude) as double), -74.0060) median_lng from pc",
)
def q_reference_median(spark, sf):
    return scoring.reference_median(_study_panel(spark, sf), "business_latitude", "business_longitude")


@query(
    "clamp_bounds",
    O.with_ctes("loc") + "select business_id, least(greatest(business_latitude, 40.49), 40.92) business_latitude,"
    " least(greatest(business_longitude, -74.27), -73.68) business_longitude from loc",
)
def q_clamp(spark, sf):
    return spatial.clamp_bounds(_locations(spark, sf), "business_latitude", "business_longitude")


@query("distinct_centroids", O.with_ctes("panel_core") + O.CENTROID_SQL)
def q_distinct_centroids(spark, sf):
    return scoring.distinct_centroids(_fixed_panel(spark, sf), "location_cluster", "location_cluster_lat", "location_cluster_lng")


@query("nearest_centroid", O.with_ctes("loc") + "select * replace (cast(location_cluster as double) as location_cluster) from (" + O.CLUSTER_SQL + ") q")
def q_nearest_centroid(spark, sf):
    """Every business location mapped to the nearest of the panel's cluster centres."""
    cents = scoring.centroid_list(
        scoring.distinct_centroids(_fixed_panel(spark, sf), "location_cluster", "location_cluster_lat", "location_cluster_lng")
    )
    return spatial.nearest_centroid(_locations(spark, sf), "business_latitude", "business_longitude", cents)


def _profile_requests(training, prefix_cat="business_category_", prefix_cmp="complaint_type_", suffix_cat="_first12m_max", suffix_cmp="_first12m_sum"):
    """One request per eligible business from its first-year features."""
    cats = [c for c in training.columns if c.startswith(prefix_cat) and c.endswith(suffix_cat) and not c.startswith("business_category_sum")]
    cmps = [c for c in training.columns if c.startswith(prefix_cmp) and c.endswith(suffix_cmp)]
    cat_arr = F.filter(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in cats]), lambda x: x.isNotNull()) if cats else F.array().cast("array<string>")
    cmp_map = F.create_map(*[x for c in cmps for x in (F.lit(c), F.col(c).cast("double"))]) if cmps else F.create_map().cast("map<string,double>")
    return scoring.clamp_profile_coordinates(training.select(
        F.col("business_id").alias("profile_id"),
        F.col("active_license_count_first12m_mean").alias("active_license_count"),
        F.col("business_latitude_first12m_first").alias("business_latitude"),
        F.col("business_longitude_first12m_first").alias("business_longitude"),
        cat_arr.alias("categories"),
        cmp_map.alias("complaints"),
    ))


@query("build_profiles", O.with_ctes("train") + O.PROFILES_SQL)
def q_build_profiles(spark, sf):
    """Profile requests of every eligible business -> logistic feature rows
    (fixed centres; a column that no profile sets is 0)."""
    return scoring.build_profiles(_profile_requests(_training(spark, sf)), O.PROFILE_COLS, O.FIXED_CENTRES)


@query("predict_profiles_logistic")
def q_predict_profiles(spark, sf):
    """Probability of surviving 36 months for every profile request, ranked."""
    run = _logistic_run(spark, sf)
    cents = scoring.centroid_list(
        scoring.distinct_centroids(_full_panel(spark, sf), "location_cluster", "location_cluster_lat", "location_cluster_lng")
    )
    prof = scoring.build_profiles(_profile_requests(run.training), run.selection.kept_columns, cents)
    return logistic.predict_logistic(prof, run.model).select("profile_id", "probability", "predicted_label").orderBy(F.desc("probability"), "profile_id")


@query("directional_check_logistic")
def q_directional_logistic(spark, sf):
    run = _logistic_run(spark, sf)
    kept = run.selection.kept_columns
    prof = scoring.scenario_profiles_logistic(scoring.baseline_median_profile(run.train, kept), kept)
    scored = logistic.predict_logistic(prof, run.model, prob_col="predicted_survival_probability")
    related = scoring.relation_to_baseline(scored, "predicted_survival_probability")
    return scoring.directional_check(related, run.model.coefficient_frame(spark), "coefficient", "above_baseline", "below_baseline", "same_as_baseline")


def _cox_scenarios(spark, sf):
    run = _cox_runs(spark, sf)["time_varying"]
    kept = run.selection.kept_columns
    base = scoring.baseline_first_row(survival.restrict_study_window(_full_panel(spark, sf), FIXTURE_STUDY_END), kept)
    prof = scoring.scenario_profiles_cox(base, kept, 3)
    scaled = features.standardize(prof, run.scaler, keep=["profile", "scenario_feature"])
    return run, cox.partial_hazard(scaled, run.model)


@query("risk_vs_baseline")
def q_risk_vs_baseline(spark, sf):
    """Hazard ratio of each Cox scenario profile to the baseline profile."""
    _, scored = _cox_scenarios(spark, sf)
    return scoring.relation_to_baseline(scored, "partial_hazard", "higher_risk", "lower_risk", "same_risk").select(
        "profile", "scenario_feature", "partial_hazard", "ratio_to_baseline", "actual_vs_baseline"
    )


@query("directional_check_cox")
def q_directional_cox(spark, sf):
    run, scored = _cox_scenarios(spark, sf)
    related = scoring.relation_to_baseline(scored, "partial_hazard", "higher_risk", "lower_risk", "same_risk")
    return scoring.directional_check(related, cox.summary_frame(spark, run.model), "coef", "higher_risk", "lower_risk", "same_risk")


@query("profiles_over_time")
def q_profiles_over_time(spark, sf):
    """Time-varying profiles: each business-month of the first year as a
    timepoint, scored by the time-varying Cox model, sorted by month."""
    run = _cox_runs(spark, sf)["time_varying"]
    p = survival.first_year_window(survival.restrict_study_window(_full_panel(spark, sf), FIXTURE_STUDY_END), 12)
    cats = [c for c in p.columns if c.startswith("business_category_") and c != "business_category_sum"]
    cmps = [c for c in p.columns if c.startswith("complaint_type_")]
    req = p.select(
        F.col("business_id").alias("profile_id"), "month", "active_license_count", "business_latitude", "business_longitude",
        F.filter(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in cats]), lambda x: x.isNotNull()).alias("categories"),
        F.create_map(*[x for c in cmps for x in (F.lit(c), F.col(c).cast("double"))]).alias("complaints"),
    )
    cents = scoring.centroid_list(
        scoring.distinct_centroids(_full_panel(spark, sf), "location_cluster", "location_cluster_lat", "location_cluster_lng")
    )
    prof = scoring.build_profiles(req, run.selection.kept_columns, cents, scoring.COX_INPUTS)
    scaled = features.standardize(prof, run.scaler, keep=["profile_id", "month"])
    return cox.partial_hazard(scaled, run.model).select("profile_id", "month", "partial_hazard")


@query("check_features_available", O.with_ctes("fnames") + O.MISSING_SQL)
def q_check_features(spark, sf):
    """Scenario features that the training data doesn't have (left-anti join)."""
    req = spark.createDataFrame([(f,) for _, f, _ in scoring.LOGISTIC_SCENARIOS], "feature string")
    return scoring.check_features_available(_feature_names(spark, sf).select("feature"), req)


# ------------------------------------------------------------- 2.x geo ----
def _geo_inputs(spark, sf):
    return geojson.prepare_geojson_inputs(_panel_core(spark, sf), fixtures.license_metadata(spark, sf))


def _geo_businesses(spark, sf):
    panel_df, meta = _geo_inputs(spark, sf)
    summary = geojson.business_activity_summary(panel_df, FIXTURE_STUDY_END)
    return geojson.join_geo(summary, geojson.business_license_metadata(meta))


@query("prepare_geojson_inputs", O.with_ctes("meta") + "select * from meta")
def q_prepare_geo(spark, sf):
    """Licence metadata cleaned (ids, title-case borough, coordinates, dates),
    full address built, valid boroughs and the map box only."""
    return _geo_inputs(spark, sf)[1]


@query("business_activity_summary", O.with_ctes("gsum") + "select * from gsum")
def q_activity(spark, sf):
    return geojson.business_activity_summary(_geo_inputs(spark, sf)[0], FIXTURE_STUDY_END)


@query("business_license_metadata", O.with_ctes("gmeta") + "select * from gmeta")
def q_license_meta(spark, sf):
    return geojson.business_license_metadata(_geo_inputs(spark, sf)[1])


@query(
    "license_records",
    O.with_ctes("meta") + "select business_id, record_ordinal, latitude, longitude, borough, license_number, license_type,"
    " business_category, strftime(license_creation_date, '%Y-%m-%d') license_creation_date,"
    " strftime(license_expiration_date, '%Y-%m-%d') license_expiration_date, full_address from meta",
)
def q_license_records(spark, sf):
    rows = geojson.license_record_rows(_geo_inputs(spark, sf)[1])
    return rows.select(
        "business_id", "record_ordinal", "record.latitude", "record.longitude", "record.borough", "record.license_number",
        "record.license_type", "record.business_category", "record.license_creation_date", "record.license_expiration_date",
        "record.full_address",
    )


@query("geo_feature", O.with_ctes("gfeat") + "select * from gfeat")
def q_geo_feature(spark, sf):
    """GeoJSON features (flattened properties for comparison)."""
    f = geojson.geo_feature(_geo_businesses(spark, sf))
    p = F.col("feature.properties")
    return f.select(
        "business_id", p["active"].alias("active"), p["last_month"].alias("last_month"), p["complaint_sum"].alias("complaint_sum"),
        p["license_count"].alias("license_count"), p["borough"].alias("borough"),
        F.col("feature.geometry.coordinates")[0].alias("lng"), F.col("feature.geometry.coordinates")[1].alias("lat"),
    )


@query("write_geojson")
def q_write_geojson(spark, sf):
    """Newline-delimited GeoJSON (one Feature per line) written and read back."""
    path = geojson.write_geojson(geojson.geo_feature(_geo_businesses(spark, sf)), _scratch(spark, "geojson"))
    return spark.read.text(path)


@query("job_geojson")
def q_job_geojson(spark, sf):
    """Map export written and read back: the Features and their licence records."""
    root = _scratch(spark, "map")
    _, paths = geojson.export_map(_geo_businesses(spark, sf), _geo_inputs(spark, sf)[1], root)
    paths = {"feature": paths["geojson"], "license_record": paths["license_records"], "license_record_chunk": paths["record_chunks"]}
    feature, record, chunk = (spark.read.text(path).select(F.lit(kind).alias("kind"), "value") for kind, path in paths.items())
    return feature.unionByName(record).unionByName(chunk)


@query("scan_geojson", O.with_ctes("gfeat") + O.SCAN_GEOJSON_SQL)
def q_scan_geojson(spark, sf):
    """Features with their licence records written as lines, parsed again."""
    panel_df, meta = _geo_inputs(spark, sf)
    businesses = geojson.join_geo(geojson.business_activity_summary(panel_df, FIXTURE_STUDY_END), geojson.business_license_metadata(meta))
    feats = geojson.geo_feature(geojson.with_license_records(businesses, geojson.license_record_chunks(meta)))
    path = geojson.write_geojson(feats, _scratch(spark, "geojson-records"))
    f = spark.read.text(path).select(F.from_json("value", feats.schema["feature"].dataType).alias("f"))
    p = F.col("f.properties")
    return f.select(
        p["business_id"].alias("business_id"), p["active"].alias("active"), p["last_month"].alias("last_month"),
        p["complaint_sum"].alias("complaint_sum"), p["license_count"].alias("license_count"), p["borough"].alias("borough"),
        F.col("f.geometry.coordinates")[0].alias("lng"), F.col("f.geometry.coordinates")[1].alias("lat"),
        p["license_record_chunks"].alias("license_record_chunks"),
        F.array_join(F.transform(p["license_records"], lambda x: x["license_number"]), ",").alias("license_numbers"),
        F.array_join(F.transform(p["license_records"], lambda x: x["license_creation_date"]), ",").alias("creation_dates"),
    )


@query("facet_table", O.with_ctes("gfacet") + "select * from gfacet")
def q_facets(spark, sf):
    return geojson.facet_table(geojson.geo_feature(_geo_businesses(spark, sf)))


@query(
    "facet_values",
    O.with_ctes("gfacet") + "select complaint_bin, count(*) n from gfacet group by complaint_bin",
)
def q_facet_values(spark, sf):
    return geojson.facet_values(geojson.facet_table(geojson.geo_feature(_geo_businesses(spark, sf))), "complaint_bin")


@query(
    "facet_filter",
    O.with_ctes("gfacet") + "select * from gfacet where borough in ('Bronx', 'Queens') and status in ('Inactive')",
)
def q_facet_filter(spark, sf):
    """OR within a facet, AND across facets; the licence-band facet is empty (no filter)."""
    facets = geojson.facet_table(geojson.geo_feature(_geo_businesses(spark, sf)))
    return geojson.facet_filter(facets, {"borough": ["Bronx", "Queens"], "status": ["Inactive"], "license_band": []})


# ---------------------------------------------------------- ingest 2.1/2.2 ----
EV_SPLIT = "2024-01-15 12:00:00"
EV_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _ev_cfg():
    from tenure.plans.ingest_job import IngestConfig

    return IngestConfig("event_id", "ts", ("ts",))


def _ev_target(spark, sf):
    ev = fixtures.table(spark, sf, "events")
    return U.align_to_schema(ev.where(F.col("ts") < F.lit(EV_SPLIT).cast("timestamp")), EV_COLUMNS, ("ts",))


def _ev_source(spark, sf):
    wm = U.high_watermark(_ev_target(spark, sf), "ts").first()["watermark"]
    return U.incremental_source(fixtures.table(spark, sf, "events"), "ts", wm)


@query("high_watermark", O.with_ctes("ev_wm") + "select * from ev_wm")
def q_high_watermark(spark, sf):
    return U.high_watermark(_ev_target(spark, sf), "ts")


@query("incremental_source", O.with_ctes("ev_src") + "select * from ev_src")
def q_incremental_source(spark, sf):
    """All landing rows after the day-truncated watermark."""
    return _ev_source(spark, sf)


@query("source_limit", "select * from events where ts is not null order by ts, event_id limit 1000")
def q_source_limit(spark, sf):
    """The first page of landing rows by (timestamp, key)."""
    return U.source_page(fixtures.table(spark, sf, "events"), "ts", "event_id", 1000)


@query("align_to_schema", O.with_ctes("ev_src_aligned") + "select * from ev_src_aligned")
def q_align(spark, sf):
    return U.align_to_schema(_ev_source(spark, sf), EV_COLUMNS, ("ts",))


@query("dedupe_latest", O.with_ctes("ev_src_aligned") + "select * from ev_src_aligned")
def q_dedupe(spark, sf):
    return U.dedupe_latest(U.align_to_schema(_ev_source(spark, sf), EV_COLUMNS, ("ts",)), "event_id", "ts")


@query("upsert", O.with_ctes("ev_upsert") + "select * from ev_upsert")
def q_upsert(spark, sf):
    src = U.dedupe_latest(U.align_to_schema(_ev_source(spark, sf), EV_COLUMNS, ("ts",)), "event_id", "ts")
    return U.upsert(_ev_target(spark, sf), src, "event_id")


def _scratch(spark, name):
    import uuid

    from tenure.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


@query("stream_ingest_upsert", O.with_ctes("ev_upsert") + "select * from ev_upsert")
def q_stream_ingest(spark, sf):
    """Events landed one file set per day, streamed (availableNow) into a
    versioned table with a keyed upsert per micro-batch."""
    from tenure.streaming.ingest import stream_ingest_upsert

    root = _scratch(spark, "stream-ingest")
    ev = U.align_to_schema(fixtures.table(spark, sf, "events"), EV_COLUMNS, ("ts",))
    ev.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{root}/landing")
    q = stream_ingest_upsert(spark, f"{root}/landing", ev.schema, f"{root}/table", f"{root}/ckpt", _ev_cfg())
    q.awaitTermination()
    return U.PartitionedTable(spark, f"{root}/table", "event_id", "ts").read()


def _land_requests(requests, folder):
    """Request files by month.  A month's rows stand together (a large month in
    several files), or every task would leave a small file for each month and the
    stream a micro-batch for every few of them."""
    dated = requests.withColumn("m", F.date_format("created_date", "yyyy-MM"))
    dated.hint("rebalance", "m").write.partitionBy("m").parquet(folder)


@query(
    "stream_monthly_complaints",
    O.with_ctes("pairs") + "select business_id, month, count(unique_key) total_311 from pairs group by all",
)
def q_stream_complaints(spark, sf):
    """Request files streamed through cleaning and the radius counts into
    per-(business, month) complaint counts kept current by addition."""
    from tenure.streaming.ingest import stream_monthly_complaints

    root = _scratch(spark, "stream-complaints")
    req = fixtures.requests(spark, sf)
    _land_requests(req, f"{root}/landing")
    q = stream_monthly_complaints(spark, f"{root}/landing", req.schema, _locations(spark, sf), f"{root}/table", f"{root}/ckpt")
    q.awaitTermination()
    return U.PartitionedTable(spark, f"{root}/table", ["business_id", "month"], "_epoch", part_source="month").read().drop("_epoch")


# ------------------------------------------------- 2.10 scalar functions ----
from tenure.functions import exprs as X  # noqa: E402


def _feature_names(spark, sf):
    lic = _licenses(spark, sf)
    cats = panel.feature_dictionary_frame(lic, "business_category", CATEGORY_PREFIX)
    cmps = panel.feature_dictionary_frame(_complaint_counts(spark, sf), "complaint_type", COMPLAINT_PREFIX)
    return (
        cats.select(F.concat("feature", F.lit("_first12m_max")).alias("feature"))
        .unionByName(cmps.select(F.concat("feature", F.lit("_first12m_sum")).alias("feature")))
        .unionByName(spark.range(1).select(F.lit("active_license_count_first12m_mean").alias("feature")))
    )


@query(
    "sanitize_feature_name",
    O.with_ctes("lic") + "select business_category raw, " + O.sanitize_sql("business_category", "business_category")
    + " sanitized from (select distinct business_category from lic) t",
)
def q_sanitize(spark, sf):
    return _licenses(spark, sf).select(F.col("business_category").alias("raw")).distinct().select(
        "raw", X.sanitize_feature_name(F.col("raw"), CATEGORY_PREFIX).alias("sanitized")
    )


@query(
    "prettify_feature_name",
    O.with_ctes("fnames") + "select feature, " + O.prettify_sql("feature") + " label,"
    " case when starts_with(feature, 'business_category_') then 'category'"
    " when starts_with(feature, 'complaint_type_') then 'complaint' else 'other' end feature_group from fnames",
)
def q_prettify(spark, sf):
    n = _feature_names(spark, sf)
    return n.select("feature", X.prettify_feature_name(F.col("feature")).alias("label"), X.feature_group(F.col("feature")).alias("feature_group"))


@query(
    "display_map",
    O.with_ctes("fnames") + "select " + O.prettify_sql("feature") + " label, feature from fnames"
    " where starts_with(feature, 'business_category_') and ends_with(feature, '_first12m_max')",
)
def q_display_map(spark, sf):
    """Display label -> model column for the category features (selected by prefix/suffix)."""
    n = _feature_names(spark, sf).where(F.col("feature").startswith("business_category_") & F.col("feature").endswith("_first12m_max"))
    return n.select(X.prettify_feature_name(F.col("feature")).alias("label"), "feature")


@query(
    "haversine",
    O.with_ctes("loc") + "select business_id, 6371000.0 * " + O.HAVERSINE.format(
        blat="40.7128", blng="-74.0060", rlat="business_latitude", rlng="business_longitude") + " meters_to_reference from loc",
)
def q_haversine(spark, sf):
    """Great-circle distance of every business to the reference point."""
    return _locations(spark, sf).select(
        "business_id",
        X.haversine_meters(F.col("business_latitude"), F.col("business_longitude"), F.lit(40.7128), F.lit(-74.0060)).alias("meters_to_reference"),
    )


@query(
    "months_since_first",
    O.with_ctes("lcounts") + "select lc.business_id, lc.month, cast((year(lc.month)-year(f.first_license_date))*12"
    " + month(lc.month)-month(f.first_license_date) as integer) months_since_first_license"
    " from lcounts lc join facts f on lc.business_id = f.business_id",
)
def q_months_since(spark, sf):
    out, _ = panel.license_panel(_licenses(spark, sf))
    return out.select("business_id", "month", F.col("months_since_first_license").cast("int"))


@query(
    "last_month_event",
    O.with_ctes("pc") + "select business_id, month, cast(month = max(month) over (partition by business_id)"
    " and month < date '2001-01-01' as integer) event from pc",
)
def q_last_month_event(spark, sf):
    return survival.time_varying_panel(_panel_core(spark, sf), FIXTURE_STUDY_END).select("business_id", "month", "event")


@query(
    "dataset_sizes",
    O.with_ctes("train") + f"select 'training_dataset' dataset, count(*) n_rows, {len(O.TRAIN_FEATURES) + 5} n_columns from train"
    f" union all select 'business_level_dataset', count(*), {len(O.BL_FEATURES) + 3} from (" + O.BL_SQL + ") bl",
)
def q_dataset_sizes(spark, sf):
    t = _training(spark, sf)
    bl = survival.business_level_dataset(_panel_core(spark, sf), FIXTURE_STUDY_END)
    return t.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("training_dataset").alias("dataset"), "n_rows", F.lit(len(t.columns)).alias("n_columns")
    ).unionByName(
        bl.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit("business_level_dataset").alias("dataset"), "n_rows", F.lit(len(bl.columns)).alias("n_columns")
        )
    )


@query(
    "to_timestamp_cols",
    O.with_ctes("ev_src_aligned") + "select event_id, try_cast(cast(ts as varchar) as timestamp) ts from ev_src_aligned",
)
def q_to_timestamp(spark, sf):
    src = U.align_to_schema(_ev_source(spark, sf), EV_COLUMNS, ())  # everything as text, as landed
    return U.to_timestamp_cols(src, ["ts"]).select("event_id", "ts")


@query("coef_summary_logistic")
def q_coef_summary(spark, sf):
    return _logistic_run(spark, sf).model.coefficient_frame(spark)


@query("cox_summary")
def q_cox_summary(spark, sf):
    """Both Cox summaries, ranked by |coef| within each model."""
    runs = _cox_runs(spark, sf)
    return cox.summary_frame(spark, runs["standard"].model).withColumn("model", F.lit("standard")).unionByName(
        cox.summary_frame(spark, runs["time_varying"].model).withColumn("model", F.lit("time_varying"))
    )


# ------------------------------------------------- 2.1/2.2 files + jobs ----
def _scanned_csv(spark, sf):
    """Both exports written in their raw layout (header names, M/d/yyyy dates,
    text coordinates) and read back as strings: licences, requests."""
    from tenure.config import LICENSE_HEADER_MAP, REQUEST_HEADER_MAP, REQUEST_TS_FORMAT
    from tenure.sources import readers

    root = _scratch(spark, "csv")
    readers.write_source_csv(fixtures.licenses(spark, sf), f"{root}/licenses", LICENSE_HEADER_MAP,
                             {"issue_date": "M/d/yyyy", "expire_date": "MM/dd/yyyy"})
    readers.write_source_csv(fixtures.requests(spark, sf), f"{root}/requests", REQUEST_HEADER_MAP, {"created_date": REQUEST_TS_FORMAT})
    return readers.load_source_data(spark, f"{root}/licenses", f"{root}/requests")


@query("scan_licenses_requests", O.with_ctes("lic") + "select business_id, license_number, business_category, license_status,"
       " issue_date, expire_date, latitude, longitude, issue_month, expire_month from lic")
def q_scan_csv(spark, sf):
    """Licences of the raw exports, cleaned."""
    return cleaning.clean_licenses(_scanned_csv(spark, sf)[0]).select(
        "business_id", "license_number", "business_category", "license_status", "issue_date", "expire_date",
        "latitude", "longitude", "issue_month", "expire_month",
    )


@query("scan_service_requests", O.with_ctes("req") + "select unique_key, complaint_type, created_date, latitude, longitude, month from req")
def q_scan_requests_csv(spark, sf):
    """Requests of the raw exports, cleaned."""
    return cleaning.clean_service_requests(_scanned_csv(spark, sf)[1]).select(
        "unique_key", "complaint_type", "created_date", "latitude", "longitude", "month"
    )


@query("write_panel", O.with_ctes("panel_core") + O.FINALIZE_SQL)
def q_write_panel(spark, sf):
    """Panel written (partitioned by year, business-ordered) and scanned back."""
    from tenure.plans.panel import write_panel
    from tenure.sources.readers import scan_panel

    root = _scratch(spark, "panel")
    written = _fixed_panel(spark, sf)
    write_panel(written, f"{root}/panel")
    return scan_panel(spark, f"{root}/panel").select(*written.columns)


def _metadata_csv(spark, sf, path):
    from tenure.config import LICENSE_METADATA_HEADER_MAP
    from tenure.sources import readers

    dates = {c: "M/d/yyyy" for c in ("license_creation_date", "license_expiration_date")}
    return readers.write_source_csv(fixtures.license_metadata(spark, sf), path, LICENSE_METADATA_HEADER_MAP, dates)


@query("job_all")
def q_job_all(spark, sf):
    """Whole pipeline run from raw exports; one row with the JSON run summary."""
    from tenure.config import LICENSE_HEADER_MAP, REQUEST_HEADER_MAP, REQUEST_TS_FORMAT, ModelSettings
    from tenure.plans.run_pipeline import InputPaths, PipelineConfig, run_from_paths
    from tenure.sources import readers

    root = _scratch(spark, "run")
    readers.write_source_csv(fixtures.licenses(spark, sf), f"{root}/licenses", LICENSE_HEADER_MAP, {"issue_date": "M/d/yyyy", "expire_date": "MM/dd/yyyy"})
    readers.write_source_csv(fixtures.requests(spark, sf), f"{root}/requests", REQUEST_HEADER_MAP, {"created_date": REQUEST_TS_FORMAT})
    paths = InputPaths(f"{root}/licenses", f"{root}/requests", _metadata_csv(spark, sf, f"{root}/metadata"))
    run_from_paths(spark, paths, PipelineConfig(output_dir=root, model=ModelSettings(study_end=FIXTURE_STUDY_END)))
    return spark.read.text(f"{root}/summary").select(F.col("value").alias("summary_json"))


@query("scan_source_rejects", O.REJECTS_SQL)
def q_scan_rejects(spark, sf):
    """An export whose every 97th record has a field too many: rows read and
    records rejected."""
    from tenure.sources import readers

    root = _scratch(spark, "rejects")
    orders = fixtures.table(spark, sf, "orders")
    quoted = F.concat(F.lit('"'), F.replace("o_orderpriority", F.lit("-"), F.lit(',""')), F.lit('"'))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted, F.when(F.col("o_orderkey") % 97 == 0, F.lit("x,y")).otherwise("x"))
    lines = spark.createDataFrame([("Key,Priority,Mark",)], "value string").withColumn("k", F.lit(-1).cast("long"))
    # one file, so that its first line is the header; it is read by many tasks
    body = lines.unionByName(orders.select(line.alias("value"), F.col("o_orderkey").cast("long").alias("k")))
    body.coalesce(1).sortWithinPartitions("k").select("value").write.text(f"{root}/orders")
    read = readers.read_source(spark, f"{root}/orders", {"Key": "key", "Priority": "priority", "Mark": "mark"}, ["Key"], multi_line=False)
    kept = read.rows.select(F.lit("row").alias("kind"), "key", "priority", F.lit(3).alias("n_fields"))
    lost = read.rejects.select(F.lit("reject").alias("kind"), F.col("first_field").alias("key"), F.lit(None).cast("string").alias("priority"), "n_fields")
    return kept.unionByName(lost)


# ------------------------------------------- explicit inventory entries ----
def alias(name: str, target: str, doc: str | None = None) -> None:
    """Register ``name`` as the same computation as ``target`` (a step the
    composite query already performs end to end)."""
    QUERIES[name] = QUERIES[target]
    if target in ORACLE:
        ORACLE[name] = ORACLE[target]


for _name, _target in [
    ("join_license_panel", "license_panel"),
    ("join_complaint_panel", "complaint_panel"),
    ("join_window_counts", "first_year_aggregate"),
    ("join_training", "training_dataset"),
    ("join_survival_labels", "business_level_dataset"),
    ("union_balanced", "balance_oversample"),
    ("union_profiles", "scenario_profiles_logistic"),
    ("coef_rank", "coef_summary_logistic"),
    ("ranked_predictions", "predict_profiles_logistic"),
    ("job_panel", "write_panel"),
    ("relation_label", "risk_vs_baseline"),
    ("coef_direction", "directional_check_logistic"),
    ("safe_divide", "class_metrics"),
    ("logistic_evaluation", "evaluate_classifier"),
]:
    alias(_name, _target)


@query("clean_license_fields", O.with_ctes("meta_clean") + "select * from meta_clean")
def q_clean_license_fields(spark, sf):
    """Trimmed ids, trimmed title-case borough, numeric coordinates, dates."""
    return geojson.clean_license_fields(fixtures.license_metadata(spark, sf)).select(
        "record_ordinal", "business_id", "borough", "latitude", "longitude", "license_creation_date", "license_expiration_date"
    )


alias("title_borough", "clean_license_fields")


@query(
    "build_full_address",
    O.with_ctes("meta_raw") + "select record_ordinal, concat_ws(' ', "
    + ", ".join(f"nullif(trim(coalesce(cast({c} as varchar), '')), '')" for c in geojson.ADDRESS_PARTS) + ") full_address from meta_raw",
)
def q_full_address(spark, sf):
    return geojson.build_full_address(fixtures.license_metadata(spark, sf)).select("record_ordinal", "full_address")


@query("filter_boroughs", O.with_ctes("meta_clean") + "select record_ordinal, borough from meta_clean"
       " where borough in ('Bronx', 'Brooklyn', 'Manhattan', 'Queens', 'Staten Island')")
def q_filter_boroughs(spark, sf):
    return geojson.filter_boroughs(geojson.clean_license_fields(fixtures.license_metadata(spark, sf))).select("record_ordinal", "borough")


@query("filter_bbox", O.with_ctes("meta_clean") + "select record_ordinal, latitude, longitude from meta_clean"
       " where latitude between 40.49 and 40.92 and longitude between -74.27 and -73.68")
def q_filter_bbox(spark, sf):
    return geojson.filter_bbox(geojson.clean_license_fields(fixtures.license_metadata(spark, sf))).select("record_ordinal", "latitude", "longitude")


@query("clean_business_ids", O.with_ctes("pc0") + "select trim(business_id) business_id, month, complaint_sum from pc0"
       " where business_id is not null and trim(business_id) <> ''")
def q_clean_ids(spark, sf):
    return geojson.clean_business_ids(_panel_core(spark, sf)).select("business_id", "month", "complaint_sum")


@query("date_to_iso", O.with_ctes("meta") + "select record_ordinal, strftime(license_creation_date, '%Y-%m-%d') license_creation_date,"
       " strftime(license_expiration_date, '%Y-%m-%d') license_expiration_date from meta")
def q_date_iso(spark, sf):
    rows = geojson.license_record_rows(_geo_inputs(spark, sf)[1])
    return rows.select("record_ordinal", "record.license_creation_date", "record.license_expiration_date")


for _col in ("complaint_bin", "license_band", "status", "borough"):
    _key = {"status": "active_label", "borough": "display_borough"}.get(_col, _col)

    def _mk(col):
        def fn(spark, sf):
            return geojson.facet_table(geojson.geo_feature(_geo_businesses(spark, sf))).select("business_id", col)
        fn.__doc__ = f"Map facet '{col}' of every feature."
        return fn

    QUERIES[_key] = _mk(_col)
    ORACLE[_key] = O.with_ctes("gfacet") + f"select business_id, {_col} from gfacet"


@query("join_geo", O.with_ctes("gmeta", "gsum") + "select s.*, m.latitude, m.longitude, m.first_borough, m.license_count"
       " from gsum s join gmeta m on s.business_id = m.business_id")
def q_join_geo(spark, sf):
    return _geo_businesses(spark, sf)


@query("semi_join_eligible", O.with_ctes("elig") + "select * from pc where business_id in (select business_id from elig)")
def q_semi(spark, sf):
    p = _study_panel(spark, sf)
    e = survival.eligible_businesses(survival.survival_summary(p, SURV_MONTHS), FIXTURE_STUDY_END, SURV_MONTHS, AGG_MONTHS)
    return p.join(e.select("business_id"), "business_id", "left_semi")


@query(
    "drop_model_columns",
    O.with_ctes("pc") + "select " + ", ".join(c for c in O.PC_COLS if c not in O.COX_DROP) + " from pc",
)
def q_drop_cols(spark, sf):
    from tenure.config import COX_DROP_COLUMNS

    return cleaning.drop_columns(_study_panel(spark, sf), COX_DROP_COLUMNS)


@query("binary_columns", O.with_ctes("fya") + O.BINARY_SQL.replace("fyw_e", "fya"))
def q_binary(spark, sf):
    """Per candidate column of the first-year features: non-null values all in {0,1}."""
    p = _study_panel(spark, sf)
    e = survival.eligible_businesses(survival.survival_summary(p, SURV_MONTHS), FIXTURE_STUDY_END, SURV_MONTHS, AGG_MONTHS)
    fya = survival.first_year_aggregate(p.join(e.select("business_id"), "business_id", "left_semi"), AGG_MONTHS)
    return survival.binary_flags(fya, [c for c in fya.columns if c != "business_id"])


@query("choose_aggregation", O.with_ctes("pc") + O.CHOOSE_AGG_SQL)
def q_choose_agg(spark, sf):
    """Aggregation rule chosen for every feature column of the first-year window."""
    p = _study_panel(spark, sf)
    plan = survival.aggregation_plan(survival.first_year_window(p, AGG_MONTHS))  # one pass for the binary check
    return spark.createDataFrame(plan, "feature string, rule string")  # one row per column (schema-sized)


@query(
    "feature_columns",
    O.with_ctes("train") + "select cast(row_number() over (order by c.column_index) - 1 as integer) as position, c.column_name feature"
    " from (values " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(O.LOGIT_FEATURES)) + ") c(column_index, column_name)"
    " where (select count(*) from train) > 0",
)
def q_feature_columns(spark, sf):
    """Candidate logistic features of the training set, in column order (from
    the data's column names; nothing is read)."""
    cols = _logit_features(_training(spark, sf))
    return spark.createDataFrame(list(enumerate(cols)), "position int, feature string")


# ------------------------------------- steps at fixed cluster centres ----
def _fixed_clusters(spark, sf):
    return clustering.assign_location_clusters(_locations(spark, sf), O.FIXED_CENTRES)


@query("join_cluster_centers", O.with_ctes("loc") + O.CLUSTER_SQL)
def q_join_cluster_centers(spark, sf):
    """Located businesses with the nearest of fixed centres and its coordinates."""
    return _fixed_clusters(spark, sf)


@query("panel_finalize", O.with_ctes("panel_core") + O.FINALIZE_SQL)
def q_panel_finalize(spark, sf):
    """The whole panel at fixed centres, cluster columns included; businesses
    without a cluster are left out."""
    return _fixed_panel(spark, sf)


@query("scan_panel", O.with_ctes("panel_core") + "select * from panel_core")
def q_scan_panel(spark, sf):
    """The panel written as CSV and read back with its types."""
    from tenure.sources.readers import scan_panel

    root = _scratch(spark, "panel-typed")
    core = _panel_core(spark, sf)
    core.write.option("header", True).csv(f"{root}/p")
    back = scan_panel(spark, f"{root}/p", fmt="csv")
    return back.select(*[F.col(c).cast(core.schema[c].dataType).alias(c) for c in core.columns])


@query("pivot_risk_over_time", O.with_ctes("pc") + O.RISK_PIVOT_SQL)
def q_pivot_risk(spark, sf):
    """Month x business chart of the five riskiest businesses (top-k report) at
    fixed coefficients."""
    eta = sum((F.col(c) * F.lit(b) for c, b in O.RISK_BETA.items()), F.lit(0.0))
    scored = _study_panel(spark, sf).select("business_id", F.col("months_since_first_license").alias("month"), F.exp(eta).alias("partial_hazard"))
    top = scored.groupBy("business_id").agg(F.max("partial_hazard").alias("h")).orderBy(F.desc("h"), "business_id").limit(5).collect()
    ids = [r["business_id"] for r in top]
    wide = scoring.pivot_risk_over_time(scored, "business_id", ids)
    return wide.select("month", *[F.col(f"`{x}`").alias(f"top_{i}") for i, x in enumerate(ids, 1)])


@query("job_logistic")
def q_job_logistic(spark, sf):
    """Logistic job: metrics row (accuracy, AUC, confusion, U, p)."""
    import json

    run = _logistic_run(spark, sf)
    return spark.createDataFrame([(json.dumps(run.metrics, default=str),)], "metrics_json string")


@query("write_logistic_artifacts")
def q_write_logistic(spark, sf):
    """Logistic artifacts written, model table read back (scan_model_artifacts)."""
    from tenure.plans.logistic_job import save_logistic_artifacts

    root = _scratch(spark, "logistic")
    paths = save_logistic_artifacts(_logistic_run(spark, sf), root)
    return spark.read.parquet(paths["model"])


@query("scan_model_artifacts")
def q_scan_models(spark, sf):
    """The three models stored, loaded again and scoring every training row:
    score of the loaded model beside that of the fitted one."""
    from tenure.plans.model_store import ModelStore, save_runs

    run, runs = _logistic_run(spark, sf), _cox_runs(spark, sf)
    store = ModelStore(spark, _scratch(spark, "models"))
    save_runs(store, run, runs)
    back = store.load("logistic").score(run.training, keep=["business_id"])
    out = back.join(logistic.predict_logistic(run.training, run.model).select("business_id", F.col("probability").alias("fitted_score")), "business_id")
    out = out.select(F.lit("logistic").alias("kind"), "business_id", F.lit(None).cast("date").alias("month"), F.col("probability").alias("score"), "fitted_score")
    for kind, r in runs.items():
        loaded, keys = store.load(f"cox_{kind}"), [c for c in ("business_id", "month") if c in r.modeling.columns]
        both = cox.partial_hazard(cox.partial_hazard(r.modeling, r.model, "fitted_score"), loaded.model, "score")
        month = F.col("month") if "month" in keys else F.lit(None).cast("date")
        out = out.unionByName(both.select(F.lit(f"cox_{kind}").alias("kind"), "business_id", month.alias("month"), "score", "fitted_score"))
    return out


def _stored_fixed(spark, sf):
    """Logistic and Cox models of fixed coefficients, with the scalers of the
    data, stored and loaded."""
    from tenure.plans.model_store import ModelStore

    store = ModelStore(spark, _scratch(spark, "fixed-models"))
    t = _training(spark, sf)
    cols = _logit_features(t)
    scaler = features.fit_scaler(t, cols)
    store.save("logistic", logistic.LogisticModel(scaler, [O.fixed_weight(i) for i in range(len(cols))], O.FIXED_INTERCEPT, 0), scaler, [])
    bl = survival.business_level_dataset(_panel_core(spark, sf), FIXTURE_STUDY_END)
    names = [c for c in O.BL_FEATURES]
    scaler = features.fit_scaler(bl, names)
    baseline = pd.DataFrame(O.FIXED_BASELINE, columns=["time", "baseline_hazard", "baseline_cumulative_hazard"])
    weights, n = np.array([O.fixed_weight(i) for i in range(len(names))]), len(names)
    store.save("cox", cox.CoxModel(names, weights, np.eye(n), np.full(n, O.FIXED_CENTRE), 0.0, 1, 0, baseline), scaler, ["open"])
    return store, t, bl


@query("score_stored_logistic", O.with_ctes("train") + O.FIXED_LOGIT_SQL)
def q_score_stored_logistic(spark, sf):
    """Training rows scored by a stored model of fixed coefficients."""
    store, t, _ = _stored_fixed(spark, sf)
    return store.load("logistic").score(t, keep=["business_id"])


@query("score_stored_cox", O.with_ctes("pc") + O.FIXED_COX_SQL)
def q_score_stored_cox(spark, sf):
    """Businesses scored by a stored Cox model of fixed coefficients: partial
    hazard and survival at and between the baseline's times."""
    store, _, bl = _stored_fixed(spark, sf)
    stored = store.load("cox")
    scored = cox.survival_at(stored.score(bl, keep=["business_id"]), stored.model, O.FIXED_HORIZONS)
    return scored.select("business_id", "partial_hazard", *[f"survival_prob_{t}m" for t in O.FIXED_HORIZONS])


def _cox_artifacts(spark, sf, *kinds):
    """Artifacts of the given models written and read back: one row a file
    table with its rows, and the summaries."""
    from tenure.plans.cox_job import save_cox_artifacts

    root = _scratch(spark, "cox")
    paths = {kind: save_cox_artifacts(_cox_runs(spark, sf)[kind], root) for kind in kinds}
    out = None
    for kind, own in paths.items():
        back = spark.read.parquet(own["summary"]).withColumn("model", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return paths, out


@query("write_cox_artifacts")
def q_write_cox(spark, sf):
    """Artifacts of both Cox models written, their summaries read back."""
    return _cox_artifacts(spark, sf, "standard", "time_varying")[1]


def _cox_job(*kinds):
    def fn(spark, sf):
        paths, _ = _cox_artifacts(spark, sf, *kinds)
        out = None
        for kind, own in sorted(paths.items()):
            for name, path in sorted(own.items()):
                back = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
                back = back.select(F.lit(kind).alias("model"), F.lit(name).alias("artifact"), "n_rows")
                out = back if out is None else out.unionByName(back)
        return out

    fn.__doc__ = "Cox job: every artifact written, read back and counted."
    return fn


QUERIES["job_cox"] = _cox_job("standard", "time_varying")
QUERIES["job_cox_standard"] = _cox_job("standard")
QUERIES["job_cox_time_varying"] = _cox_job("time_varying")


@query("job_ingest", O.with_ctes("ev_upsert") + "select * from ev_upsert")
def q_job_ingest(spark, sf):
    """Two incremental runs against a partitioned table: bootstrap with the
    first half of the events, then the watermark run over all landed events."""
    from tenure.plans.ingest_job import ingest

    root = _scratch(spark, "ingest")
    table = U.PartitionedTable(spark, f"{root}/table", "event_id", "ts")
    table.upsert(_ev_target(spark, sf))
    landing = U.align_to_schema(fixtures.table(spark, sf, "events"), EV_COLUMNS, ("ts",))
    ingest(spark, f"{root}/table", landing, _ev_cfg())
    return table.read()


@query("pivot_trajectory")
def q_pivot_trajectory(spark, sf):
    """Survival horizon (rows) × Cox scenario profile (columns)."""
    from tenure.config import INSPECT_SURVIVAL_TIMES

    run = _cox_runs(spark, sf)["standard"]
    kept = run.selection.kept_columns
    base = scoring.baseline_first_row(survival.restrict_study_window(_full_panel(spark, sf), FIXTURE_STUDY_END), kept)
    prof = scoring.scenario_profiles_cox(base, kept, 3)
    scored = cox.survival_at(cox.partial_hazard(features.standardize(prof, run.scaler, keep=["profile"]), run.model), run.model, INSPECT_SURVIVAL_TIMES)
    long = scored.select("profile", F.explode(F.array(*[F.struct(F.lit(t).alias("horizon_months"), F.col(f"survival_prob_{t}m").alias("s")) for t in INSPECT_SURVIVAL_TIMES])).alias("x"))
    names = ["baseline", "electronics_store", "electronic_cigarette_dealer", "bingo_game_operator", "multi_license_business"]
    return long.select("profile", "x.*").groupBy("horizon_months").pivot("profile", names).agg(F.first("s")).orderBy("horizon_months")


# ------------------------------------------- remaining inventory entries ----
for _name, _target in [
    ("feature_dictionary", "feature_dictionary_categories"),
    ("feature_group", "prettify_feature_name"),
    ("directional_check", "directional_check_logistic"),
]:
    alias(_name, _target)


@query(
    "select_category_cols",
    O.with_ctes("fnames") + "select feature from fnames where starts_with(feature, 'business_category_') and ends_with(feature, '_first12m_max')",
)
def q_select_cats(spark, sf):
    n = _feature_names(spark, sf)
    return n.where(F.col("feature").startswith("business_category_") & F.col("feature").endswith("_first12m_max"))


@query(
    "select_complaint_cols",
    O.with_ctes("fnames") + "select feature from fnames where starts_with(feature, 'complaint_type_') and ends_with(feature, '_first12m_sum')",
)
def q_select_cmps(spark, sf):
    n = _feature_names(spark, sf)
    return n.where(F.col("feature").startswith("complaint_type_") & F.col("feature").endswith("_first12m_sum"))


@query("complaint_signal", O.with_ctes("pc0") + "select business_id, month, cast(complaint_sum as double) complaint_value from pc0")
def q_complaint_signal(spark, sf):
    p = _panel_core(spark, sf)
    return p.select("business_id", "month", geojson.complaint_signal(p).alias("complaint_value"))


@query("panel_sort", O.with_ctes("panel_core") + O.FINALIZE_SQL)
def q_panel_sort(spark, sf):
    """Panel rows of a business together and month-ordered (no global sort)."""
    return panel.sort_panel(_fixed_panel(spark, sf))


@query("validate_panel_map", O.with_ctes("pc0") + O.SIGNAL_SQL)
def q_validate_panel_map(spark, sf):
    """Map-side panel check; one row per business with the signal column used."""
    p = _panel_core(spark, sf)
    col = geojson.validate_panel_map(p)
    return geojson.clean_business_ids(p).select("business_id").distinct().withColumn("signal_column", F.lit(col))


@query("validate_license_metadata", O.with_ctes("meta_raw") + "select business_id, latitude, longitude, borough from meta_raw")
def q_validate_meta(spark, sf):
    meta = fixtures.license_metadata(spark, sf)
    geojson.validate_license_metadata(meta)
    return meta.select("business_id", "latitude", "longitude", "borough")


@query("scan_panel_map", O.with_ctes("pc0") + "select business_id, month, cast(complaint_sum as double) complaint_sum from pc0")
def q_scan_panel_map(spark, sf):
    """Panel written as CSV, read back as text: month parsed, id as string."""
    from tenure.sources.readers import scan_panel

    root = _scratch(spark, "panel-csv")
    _panel_core(spark, sf).select("business_id", "month", "complaint_sum").write.option("header", True).csv(f"{root}/p")
    back = scan_panel(spark, f"{root}/p", fmt="csv")
    return back.select("business_id", "month", geojson.complaint_signal(back).alias("complaint_sum"))


@query("scan_license_metadata", O.with_ctes("meta_raw") + "select " + ", ".join(O.METADATA_COLUMNS) + " from meta_raw")
def q_scan_meta(spark, sf):
    """Licence metadata written in the raw export layout and read back, every
    column of the export."""
    from tenure.functions.exprs import to_date, to_double
    from tenure.sources import readers

    raw = readers.load_license_metadata(spark, _metadata_csv(spark, sf, _scratch(spark, "meta-csv")))
    text = raw.schema["latitude"].dataType
    typed = {c: to_double(F.col(c), text) for c in ("latitude", "longitude")}
    typed |= {c: to_date(F.col(c), text, "M/d/yyyy") for c in ("license_creation_date", "license_expiration_date")}
    return raw.select(*[typed.get(c, F.col(c)).alias(c) for c in O.METADATA_COLUMNS])


@query("write_table_artifact", O.with_ctes("train") + "select * from train")
def q_write_table(spark, sf):
    """Training dataset written as a table artifact and read back."""
    root = _scratch(spark, "table")
    _training(spark, sf).write.mode("overwrite").parquet(f"{root}/training")
    return spark.read.parquet(f"{root}/training")


@query("write_json_artifact", O.with_ctes("train") + O.EVAL_SQL)
def q_write_json(spark, sf):
    """Evaluation metrics written as a one-row JSON artifact and read back."""
    root = _scratch(spark, "json")
    evaluation.evaluate_classifier(_eval_scored(spark, sf), "survived_36m", "probability", "predicted_label").write.mode("overwrite").json(f"{root}/metrics")
    return spark.read.json(f"{root}/metrics")


@query("baseline_profiles")
def q_baseline_profiles(spark, sf):
    """Baseline new-business profile (median location, one licence) built
    for the logistic model and scored."""
    run = _logistic_run(spark, sf)
    cents = scoring.centroid_list(
        scoring.distinct_centroids(_full_panel(spark, sf), "location_cluster", "location_cluster_lat", "location_cluster_lng")
    )
    req = scoring.baseline_requests(run.training, "business_latitude_first12m_first", "business_longitude_first12m_first")
    prof = scoring.build_profiles(req, run.selection.kept_columns, cents)
    return logistic.predict_logistic(prof, run.model)


@query("flatten_timelines", O.with_ctes("pc") + O.FLATTEN_SQL)
def q_flatten(spark, sf):
    """Every business-month of the study panel as a timeline point: licence
    count, coordinates, categories and complaint counts as display text."""
    p = _study_panel(spark, sf)
    cats = [c for c in p.columns if c.startswith("business_category_") and c != "business_category_sum"]
    cmps = [c for c in p.columns if c.startswith("complaint_type_")]
    tp = p.select(
        F.col("business_id").alias("business"), F.col("months_since_first_license").alias("month"), "active_license_count",
        "business_latitude", "business_longitude",
        F.filter(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in cats]), lambda x: x.isNotNull()).alias("categories"),
        F.map_filter(F.create_map(*[x for c in cmps for x in (F.lit(c), F.col(c).cast("double"))]), lambda k, v: v > 0).alias("complaints"),
    )
    return scoring.flatten_timelines(tp, [*cats, *cmps])


@query("job_inspect_logistic")
def q_job_inspect_logistic(spark, sf):
    """Inspection run of the logistic model: scenario scores ranked, with
    the directional check of each scenario."""
    from tenure.plans.inspect_job import inspect_logistic

    ins = inspect_logistic(_logistic_run(spark, sf))
    return ins.scores.join(ins.checks.withColumnRenamed("actual_vs_baseline", "checked_vs_baseline"), "profile", "left")


@query("job_inspect_cox")
def q_job_inspect_cox(spark, sf):
    """Inspection run of the time-varying Cox model: scenario hazards,
    relation to baseline and directional checks."""
    from tenure.plans.inspect_job import inspect_cox

    ins = inspect_cox(_cox_runs(spark, sf)["time_varying"], _full_panel(spark, sf), FIXTURE_STUDY_END)
    return ins.scores.select("profile", "partial_hazard", "ratio_to_baseline", "actual_vs_baseline").join(
        ins.checks.select("profile", "expected_vs_baseline", "matches_expectation"), "profile", "left"
    )


@query("balanced_class_counts", O.with_ctes("train") + O.BALANCED_COUNTS_SQL)
def q_balanced_counts(spark, sf):
    """Rows per class after oversampling the minority to the majority size."""
    t = _training(spark, sf)
    bal = sampling.balance_oversample(t.select("business_id", *_logit_features(t), "survived_36m"), "survived_36m", ["business_id"], 42)
    return bal.groupBy("survived_36m").agg(F.count(F.lit(1)).alias("n"))


@query("split_sizes", O.with_ctes("train") + O.SPLIT_SIZES_SQL)
def q_split_sizes(spark, sf):
    """Rows per non-empty (split, class) group of the seeded stratified
    80/20 split."""
    t = _training(spark, sf)
    data = t.select("business_id", *_logit_features(t), "survived_36m").withColumn("_copy", F.lit(-1).cast("long"))
    train, test = sampling.stratified_split(data, "survived_36m", ["business_id", "_copy"], 0.2, 42)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split", "survived_36m").agg(F.count(F.lit(1)).alias("n"))
