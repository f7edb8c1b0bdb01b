import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"business_id", "month", "location_cluster", "complaint_sum"} <= set(df.columns)


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_query_sample(spark):
    import duckdb

    from tools_check import compare

    sf = "/root/testdata/sf0.001"
    for name in ("merge_panel", "training_dataset", "evaluate_classifier", "geo_feature", "upsert"):
        assert compare(spark, sf, name), name


def test_run_pipeline_end_to_end(spark, tmp_path):
    import datetime as dt
    import json

    from tenure.config import ModelSettings
    from tenure.plans.run_pipeline import PipelineConfig, run_pipeline
    from tenure.sources import fixtures

    sf = "/root/testdata/sf0.001"
    cfg = PipelineConfig(output_dir=str(tmp_path / "run"), model=ModelSettings(study_end=dt.date(2001, 1, 1)),
                         extra={"feature_collection": True})
    summary = run_pipeline(fixtures.licenses(spark, sf), fixtures.requests(spark, sf), fixtures.license_metadata(spark, sf), cfg)
    assert summary["panel_rows"] > 0
    assert 0 <= summary["logistic"]["accuracy"] <= 1
    assert set(summary["cox"]) == {"time_varying", "standard"}
    written = json.loads(spark.read.text(str(tmp_path / "run" / "summary")).first().value)
    assert written["panel_rows"] == summary["panel_rows"]
    assert spark.read.parquet(str(tmp_path / "run" / "cox" / "standard" / "summary")).count() == summary["cox"]["standard"]["features"]
    fc = json.loads("".join(r.value for r in spark.read.text(summary["feature_collection_path"]).collect()))
    assert len(fc["features"]) == spark.read.text(summary["geojson_path"]).count()
