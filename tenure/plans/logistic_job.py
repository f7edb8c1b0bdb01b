"""Logistic survival model: panel -> training set -> variance filter ->
balance -> stratified split -> scale -> L2 logistic -> evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import LOGISTIC_EXCLUDED, ModelSettings
from tenure.operators import cleaning, evaluation, features, logistic, sampling, survival
from tenure.operators.sampling import _checkpoint

LABEL = "survived_36m"


@dataclass
class LogisticRun:
    training: DataFrame
    selection: features.FeatureSelection
    balanced: DataFrame
    train: DataFrame
    test: DataFrame
    model: logistic.LogisticModel
    scored: DataFrame
    metrics: dict


def prepare_training(panel: DataFrame, settings: ModelSettings) -> tuple[DataFrame, features.FeatureSelection]:
    study = survival.restrict_study_window(panel, settings.study_end)
    training = survival.training_dataset(study, settings.study_end, settings.survival_months, settings.aggregation_months)
    training = _checkpoint(training)  # one row per business; reused by every later step
    candidates = features.feature_columns(training.columns, LOGISTIC_EXCLUDED)
    selection = features.variance_filter(training, candidates, settings.variance_threshold)
    return training, selection


def run_logistic(panel: DataFrame, settings: ModelSettings = ModelSettings(), validate: bool = True) -> LogisticRun:
    if validate:
        cleaning.validate_panel(panel)
    training, selection = prepare_training(panel, settings)
    data = training.select("business_id", *selection.kept_columns, LABEL)
    if settings.balance == "train_only":
        train, test = sampling.stratified_split(
            data.withColumn("_copy", F.lit(-1).cast("long")), LABEL, ["business_id", "_copy"],
            settings.test_size, settings.random_state,
        )
        balanced = train = sampling.balance_oversample(train.drop("_copy"), LABEL, ["business_id"], settings.random_state)
    else:
        balanced = sampling.balance_oversample(data, LABEL, ["business_id"], settings.random_state)
        train, test = sampling.stratified_split(balanced, LABEL, ["business_id", "_copy"], settings.test_size, settings.random_state)
    scaler = features.fit_scaler(train, selection.kept_columns)
    model = logistic.fit_logistic(
        features.standardize(train, scaler, keep=[LABEL]), LABEL, scaler, settings.c, settings.max_iter
    )
    scored = logistic.predict_logistic(test, model)
    row = evaluation.evaluate_classifier(scored, LABEL, "probability", "predicted_label").first().asDict()
    row["mannwhitney_p_value"] = evaluation.mannwhitney_p(row["mannwhitney_z"]) if row["mannwhitney_z"] is not None else None
    row["confusion_matrix"] = [[row["tn"], row["fp"]], [row["fn"], row["tp"]]]
    return LogisticRun(training, selection, balanced, train, test, model, scored, row)


def save_logistic_artifacts(run: LogisticRun, out_dir: str) -> dict[str, str]:
    """Model table, kept/dropped features, coefficients, splits, metrics, and
    the model in the store below ``models``."""
    import json

    from tenure.plans.model_store import ModelStore

    spark = run.training.sparkSession
    paths = {}

    def put(name, df, fmt="parquet"):
        path = f"{out_dir.rstrip('/')}/{name}"
        getattr(df.write.mode("overwrite"), fmt)(path)
        paths[name] = path

    put("model", run.model.scaler.frame(spark).join(
        spark.createDataFrame(list(zip(run.model.scaler.columns, run.model.coefficients)), "feature string, coefficient double"),
        "feature",
    ).withColumn("intercept", F.lit(float(run.model.intercept))))
    put("kept_features", spark.createDataFrame([(c,) for c in run.selection.kept_columns], "feature string"))
    put("dropped_features", spark.createDataFrame([(c,) for c in run.selection.dropped_columns], "feature string"))
    put("coefficients", run.model.coefficient_frame(spark))
    put("training_dataset", run.training)
    put("balanced", run.balanced)
    put("train_split", run.train)
    put("test_split", run.test)
    metrics = dict(run.metrics)
    metrics["intercept"] = run.model.intercept
    put("metrics", spark.createDataFrame([(json.dumps(metrics, default=str),)], "value string"), "text")
    root = f"{out_dir.rstrip('/')}/models"
    version = ModelStore(spark, root).save("logistic", run.model, run.model.scaler, run.selection.dropped_columns)
    paths["stored_model"] = f"{root}/kind=logistic/version={version}"
    return paths
