"""Cox survival models: time-varying (business-month intervals) and
standard (one row per business).  Each reads the panel as the caller saved it (best by business,
``plans.panel.saved_panel``): neither keeps a copy of it or of its intervals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tenure.config import ModelSettings
from tenure.operators import cleaning, cox, features, survival
from tenure.operators.sampling import _saved


@dataclass
class CoxRun:
    kind: str
    modeling: DataFrame
    selection: features.FeatureSelection
    scaler: features.Scaler
    model: cox.CoxModel


def prepare_time_varying(panel: DataFrame, settings: ModelSettings):
    tv = survival.time_varying_panel(panel, settings.study_end)
    cand = features.feature_columns(tv.columns, ["business_id", "month", "start", "stop", "event"])
    sel, scaler = features.filter_and_scale(tv, cand, settings.variance_threshold)
    modeling = features.standardize(tv, scaler, keep=["business_id", "month", "start", "stop", "event"])
    return modeling, sel, scaler


def prepare_business_level(panel: DataFrame, settings: ModelSettings):
    bl = _saved(survival.business_level_dataset(panel, settings.study_end), "business-level")  # a row per business, read by every later step
    cand = features.feature_columns(bl.columns, ["business_id", "duration_months", "event"])
    sel, scaler = features.filter_and_scale(bl, cand, settings.variance_threshold)
    modeling = features.standardize(bl, scaler, keep=["business_id", "duration_months", "event"])
    return modeling, sel, scaler


def run_time_varying(panel: DataFrame, settings: ModelSettings = ModelSettings()) -> CoxRun:
    modeling, sel, scaler = prepare_time_varying(panel, settings)
    model = cox.fit_cox(modeling, sel.kept_columns, "stop", "event", start_col="start", penalizer=settings.penalizer)
    return CoxRun("time_varying", modeling, sel, scaler, model)


def run_standard(panel: DataFrame, settings: ModelSettings = ModelSettings()) -> CoxRun:
    modeling, sel, scaler = prepare_business_level(panel, settings)
    model = cox.fit_cox(modeling, sel.kept_columns, "duration_months", "event", penalizer=settings.penalizer, baseline=True)
    return CoxRun("standard", modeling, sel, scaler, model)


def run_cox(panel: DataFrame, settings: ModelSettings = ModelSettings(), validate: bool = True) -> dict[str, CoxRun]:
    if validate:
        cleaning.validate_panel(panel)
    shared = survival.restrict_study_window(panel, settings.study_end)
    # the two fits are independent job sequences: run them side by side
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=2) as pool:
        tv = pool.submit(run_time_varying, shared, settings)
        std = pool.submit(run_standard, shared, settings)
        return {"time_varying": tv.result(), "standard": std.result()}


def save_cox_artifacts(run: CoxRun, out_dir: str) -> dict[str, str]:
    """Summary, scaler, centring means, kept and dropped features, baseline
    hazard (standard model) and the model in the store below ``models``."""
    from tenure.plans.model_store import ModelStore

    spark = run.modeling.sparkSession
    base = f"{out_dir.rstrip('/')}/{run.kind}"
    paths = {}

    def put(name, df):
        paths[name] = f"{base}/{name}"
        df.write.mode("overwrite").parquet(paths[name])

    put("summary", cox.summary_frame(spark, run.model))
    put("scaler", run.scaler.frame(spark))
    put("centring", spark.createDataFrame(list(zip(run.model.features, map(float, run.model.norm_mean))), "feature string, mean double"))
    put("kept", spark.createDataFrame([(c,) for c in run.selection.kept_columns], "feature string"))
    put("dropped", spark.createDataFrame([(c,) for c in run.selection.dropped_columns], "feature string"))
    if run.model.baseline is not None:
        put("baseline_hazard", spark.createDataFrame(run.model.baseline))
    root = f"{out_dir.rstrip('/')}/models"
    version = ModelStore(spark, root).save(f"cox_{run.kind}", run.model, run.scaler, run.selection.dropped_columns)
    paths["model"] = f"{root}/kind=cox_{run.kind}/version={version}"
    return paths
