"""Whole pipeline: panel -> logistic -> Cox (both) -> GeoJSON, panel built
and saved once, artifacts under one output folder, JSON summary."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tenure.config import ModelSettings, PanelSettings
from tenure.operators import geojson
from tenure.operators.sampling import _saved
from tenure.plans.cox_job import run_cox, save_cox_artifacts
from tenure.plans.logistic_job import run_logistic, save_logistic_artifacts
from tenure.plans.panel import saved_panel, write_panel
from tenure.sources import readers


@dataclass(frozen=True)
class PipelineConfig:
    output_dir: str
    panel: PanelSettings = PanelSettings()
    model: ModelSettings = ModelSettings()
    map_cutoff: object = None  # defaults to the study end
    stages: tuple = ("panel", "logistic", "cox", "geojson")
    extra: dict = field(default_factory=dict)


@dataclass(frozen=True)
class InputPaths:
    """Raw exports: licences and requests are needed, the map's records not."""

    licenses: str
    requests: str
    metadata: str | None = None


def missing_inputs(spark: SparkSession, paths: InputPaths) -> list[str]:
    """Named inputs that are not there, on whatever file system they name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named = [p for p in (paths.licenses, paths.requests, paths.metadata) if p is not None]
    out = []
    for p in named:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if not path.getFileSystem(conf).exists(path):
            out.append(p)
    return out


def run_from_paths(spark: SparkSession, paths: InputPaths, cfg: PipelineConfig) -> dict:
    """The whole run from raw exports; nothing is started if one is missing."""
    if gone := missing_inputs(spark, paths):
        raise FileNotFoundError(f"input not found: {', '.join(gone)}")
    licenses, requests = readers.load_source_data(spark, paths.licenses, paths.requests)
    metadata = readers.load_license_metadata(spark, paths.metadata) if paths.metadata else None
    # each is read several times: the text is parsed once
    licenses, requests = _saved(licenses, "source-licenses"), _saved(requests, "source-requests")
    if metadata is not None and "geojson" in cfg.stages:
        metadata = _saved(metadata, "source-metadata")
    return run_pipeline(licenses, requests, metadata, cfg)


def run_pipeline(licenses_raw: DataFrame, requests_raw: DataFrame, metadata_raw: DataFrame | None, cfg: PipelineConfig) -> dict:
    out = cfg.output_dir.rstrip("/")
    summary: dict = {}
    panel_df = saved_panel(licenses_raw, requests_raw, cfg.panel)
    if "panel" in cfg.stages:
        summary["panel_path"] = write_panel(panel_df, f"{out}/panel")
        summary["panel_rows"] = panel_df.count()
    if "logistic" in cfg.stages:
        run = run_logistic(panel_df, cfg.model)
        save_logistic_artifacts(run, f"{out}/logistic")
        summary["logistic"] = {
            "kept_features": len(run.selection.kept_columns),
            "accuracy": run.metrics["accuracy"],
            "roc_auc": run.metrics["roc_auc"],
            "n_train": run.model.n_train,
        }
    if "cox" in cfg.stages:
        runs = run_cox(panel_df, cfg.model)
        summary["cox"] = {}
        for kind, r in runs.items():
            save_cox_artifacts(r, f"{out}/cox")
            summary["cox"][kind] = {"features": len(r.selection.kept_columns), "iterations": r.model.iterations, "converged": r.model.converged, "rows": r.model.n_rows}
    if "geojson" in cfg.stages and metadata_raw is not None:
        p, meta = geojson.prepare_geojson_inputs(panel_df, metadata_raw)
        s = geojson.business_activity_summary(p, cfg.map_cutoff or cfg.model.study_end)
        feats, paths = geojson.export_map(geojson.join_geo(s, geojson.business_license_metadata(meta)), meta, out)
        summary |= {f"{name}_path": path for name, path in paths.items()}
        if cfg.extra.get("feature_collection"):  # opt-in single document, size-checked
            summary["feature_collection_path"] = geojson.write_feature_collection(feats, f"{out}/feature_collection")
    summary_json = json.dumps(summary, default=str, sort_keys=True)
    panel_df.sparkSession.createDataFrame([(summary_json,)], "value string").write.mode("overwrite").text(f"{out}/summary")
    return summary
