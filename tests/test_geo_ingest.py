import datetime as dt
import json

from pyspark.sql import functions as F

from tenure.operators import geojson
from tenure.operators import upsert as U


def test_boroughs_box_and_feature(spark):
    meta = spark.createDataFrame(
        [(1, " B1 ", 40.75, -73.90, " queens ", "5", "Main St"), (2, "B2", 40.75, -73.90, "Boston", None, None),
         (3, "B3", 39.0, -73.90, "Bronx", None, None)],
        "record_ordinal long, business_id string, latitude double, longitude double, borough string,"
        " address_building string, address_street_name string",
    )
    panel = spark.createDataFrame([("B1", dt.date(2026, 3, 1), 2), ("B1", dt.date(2025, 1, 1), 1)], "business_id string, month date, complaint_sum long")
    p, lic = geojson.prepare_geojson_inputs(panel, meta)
    rows = lic.collect()
    assert [(r.business_id, r.borough, r.full_address) for r in rows] == [("B1", "Queens", "5 Main St")]
    s = geojson.business_activity_summary(p, dt.date(2026, 3, 1))
    feat = geojson.geo_feature(geojson.join_geo(s, geojson.business_license_metadata(lic)))
    doc = json.loads(feat.select(F.to_json("feature")).first()[0])
    assert doc["geometry"]["coordinates"] == [-73.9, 40.75]
    assert doc["properties"]["active"] == 1 and doc["properties"]["complaint_sum"] == 3.0
    assert doc["properties"]["last_month"] == "2026-03-01" and doc["properties"]["license_count"] == 1


def test_facets(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (7.0,), (101.0,), (None,)], "v double")
    assert [r[0] for r in df.select(geojson.complaint_bin(F.col("v"))).collect()] == ["0", "1-2", "6-10", "101+", "Unknown"]


def test_upsert_and_dedupe(spark):
    target = spark.createDataFrame([("1", "a", "2024-01-01 00:00:00"), ("2", "b", "2024-01-01 00:00:00")], "k string, v string, ts string")
    target = target.withColumn("ts", F.col("ts").cast("timestamp"))
    src = spark.createDataFrame([("2", "b2", "2024-01-02 00:00:00"), ("2", "b3", "2024-01-03 00:00:00"), ("3", "c", "2024-01-02 00:00:00")], "k string, v string, ts string")
    src = U.dedupe_latest(src.withColumn("ts", F.col("ts").cast("timestamp")), "k", "ts")
    out = sorted((r.k, r.v) for r in U.upsert(target, src, "k").collect())
    assert out == [("1", "a"), ("2", "b3"), ("3", "c")]
    wm = U.high_watermark(target, "ts").first().watermark
    assert wm == dt.datetime(2024, 1, 1)


def test_versioned_table_and_stream_equals_batch(spark, tmp_path):
    from tenure.plans.ingest_job import IngestConfig
    from tenure.streaming.ingest import stream_ingest_upsert

    rows = [(str(i % 7), f"v{i}", dt.datetime(2024, 1, 1 + i % 5, i % 24)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, v string, ts timestamp")
    df.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(str(tmp_path / "landing"))
    cfg = IngestConfig("k", "ts", ("ts",))
    q = stream_ingest_upsert(spark, str(tmp_path / "landing"), df.schema, str(tmp_path / "table"), str(tmp_path / "ckpt"), cfg, files_per_trigger=1)
    q.awaitTermination()
    got = sorted((r.k, r.v) for r in U.PartitionedTable(spark, str(tmp_path / "table"), "k", "ts").read().collect())
    want = sorted((r.k, r.v) for r in U.dedupe_latest(df, "k", "ts").collect())
    assert got == want


def test_latest_wins_merge_is_replay_safe(spark, tmp_path):
    rows = [("1", "old", dt.datetime(2024, 1, 1)), ("2", "b", dt.datetime(2024, 1, 2))]
    target = spark.createDataFrame(rows, "k string, v string, ts timestamp")
    late_old = spark.createDataFrame([("1", "older", dt.datetime(2023, 12, 1)), ("3", "c", dt.datetime(2024, 1, 3))], target.schema)
    newer = spark.createDataFrame([("1", "new", dt.datetime(2024, 2, 1))], target.schema)
    table = U.PartitionedTable(spark, str(tmp_path / "t"), "k", "ts", latest_wins=True)
    for batch in (target, newer, late_old, newer):  # out of order, and a replayed batch
        table.upsert(batch)
    assert sorted((r.k, r.v) for r in table.read().collect()) == [("1", "new"), ("2", "b"), ("3", "c")]


def test_upsert_updates_ties_moves_and_nulls(spark, tmp_path):
    kind = "k string, v string, ts timestamp"
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    for latest in (False, True):
        t = U.PartitionedTable(spark, str(tmp_path / f"p{latest}"), "k", "ts", latest_wins=latest)
        t.upsert(spark.createDataFrame([("tie", "Open", jan), ("moved", "a", jan), ("null", "n", None)], kind))
        t.upsert(spark.createDataFrame([("tie", "Closed", jan), ("moved", "b", feb), ("other", "m", None)], kind))
        want = [("moved", "b"), ("null", "n"), ("other", "m"), ("tie", "Closed")]
        assert sorted((r.k, r.v) for r in t.read().collect()) == want
    t.upsert(spark.createDataFrame([("tie", "x", feb)], kind))  # January is empty now
    assert sorted((r.k, r.v) for r in t.read().collect()) == [("moved", "b"), ("null", "n"), ("other", "m"), ("tie", "x")]


def test_ingest_takes_a_whole_day_and_bad_timestamps(spark, tmp_path):
    from tenure.plans.ingest_job import IngestConfig, ingest

    day = dt.datetime.combine(dt.date.today(), dt.time(12))
    rows = [(str(i), f"v{i}", str(day)) for i in range(50)] + [("bad", "x", "not a date"), ("none", "y", None)]
    landing = spark.createDataFrame(rows, "k string, v string, ts string")
    cfg = IngestConfig("k", "ts", ("ts",))
    assert ingest(spark, str(tmp_path / "t"), landing, cfg) == 50
    more = spark.createDataFrame([("7", "changed", str(day)), ("new", "z", str(day))], landing.schema)
    ingest(spark, str(tmp_path / "t"), more, cfg)
    got = {r.k: r.v for r in U.PartitionedTable(spark, str(tmp_path / "t"), "k", "ts").read().collect()}
    assert len(got) == 51 and got["7"] == "changed" and got["8"] == "v8"


def test_source_pages_cover_a_large_timestamp(spark):
    day = dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([(str(i), day) for i in range(10)], "k string, ts timestamp")
    seen, after = [], None
    while page := U.source_page(df, "ts", "k", 3, after).collect():
        seen += [r.k for r in page]
        after = (page[-1].ts, page[-1].k)
    assert seen == sorted(map(str, range(10)))


def test_csv_sources_keep_quotes_and_types(spark, tmp_path):
    from tenure.sources.readers import read_source_csv, scan_panel

    (tmp_path / "a.csv").write_text('A,B\n"say ""hi"", ok",x\n"two\nlines",y\n')
    got = read_source_csv(spark, str(tmp_path / "a.csv"), {"A": "a", "B": "b"}, ("A", "B")).collect()
    assert [(r.a, r.b) for r in got] == [('say "hi", ok', "x"), ("two\nlines", "y")]
    (tmp_path / "p.csv").write_text("business_id,month,business_latitude,complaint_sum\n007,2024-01-01,40.5,3.0\n")
    df = scan_panel(spark, str(tmp_path / "p.csv"), "csv")
    assert dict(df.dtypes)["complaint_sum"] == "bigint" and df.first().business_id == "007"


def test_local_checkpoint_folder_is_refused_on_a_cluster():
    import pytest

    from tenure.session import ensure_checkpoint_dir

    class Stub:
        class conf:
            get = staticmethod(lambda k, d=None: None)

        class sparkContext:
            master = "yarn"

            class _jsc:
                @staticmethod
                def sc():
                    class Dir:
                        isDefined = staticmethod(lambda: False)

                    return type("S", (), {"getCheckpointDir": staticmethod(lambda: Dir)})

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Stub)


def test_partitioned_upsert_touches_only_batch_months(spark, tmp_path):
    import os

    t = U.PartitionedTable(spark, str(tmp_path / "p"), "k", "ts")
    base = spark.createDataFrame(
        [("1", "a", dt.datetime(2024, 1, 5)), ("2", "b", dt.datetime(2024, 2, 5)), ("3", "c", dt.datetime(2024, 3, 5))],
        "k string, v string, ts timestamp",
    )
    assert t.upsert(base) == 3
    jan = str(tmp_path / "p" / "part_month=2024-01")
    before = {f: os.path.getmtime(os.path.join(jan, f)) for f in os.listdir(jan)}
    batch = spark.createDataFrame([("2", "b2", dt.datetime(2024, 2, 5, 1)), ("4", "d", dt.datetime(2024, 3, 9))], base.schema)
    assert t.upsert(batch) == 2  # February and March only
    assert {f: os.path.getmtime(os.path.join(jan, f)) for f in os.listdir(jan)} == before
    assert sorted((r.k, r.v) for r in t.read().collect()) == [("1", "a"), ("2", "b2"), ("3", "c"), ("4", "d")]


def test_stream_monthly_complaints_equals_batch(spark, tmp_path):
    from tenure.operators import cleaning, spatial
    from tenure.streaming.ingest import stream_monthly_complaints

    biz = spark.createDataFrame([("b1", 40.7000, -74.0000), ("b2", 40.7100, -74.0100)], "business_id string, business_latitude double, business_longitude double")
    rows = [(str(i), dt.datetime(2024, 1 + i % 3, 1 + i % 20, 10), "Noise", 40.7000 + (i % 7) * 0.0001, -74.0 + (i % 5) * 0.0001) for i in range(90)]
    req = spark.createDataFrame(rows, "unique_key string, created_date timestamp, complaint_type string, latitude double, longitude double")
    req.withColumn("d", F.to_date("created_date")).write.partitionBy("d").parquet(str(tmp_path / "landing"))
    q = stream_monthly_complaints(spark, str(tmp_path / "landing"), req.schema, biz, str(tmp_path / "t"), str(tmp_path / "c"), files_per_trigger=3)
    q.awaitTermination()
    got = sorted((r.business_id, r.month, r.total_311) for r in U.PartitionedTable(spark, str(tmp_path / "t"), ["business_id", "month"], "_epoch", part_source="month").read().collect())
    pairs = spatial.radius_join(biz, cleaning.clean_service_requests(req), 50.0)
    want = sorted((r.business_id, r.month, r.n) for r in pairs.groupBy("business_id", "month").agg(F.count("*").alias("n")).collect())
    assert got == want and got


def test_feature_collection_export(spark, tmp_path):
    import pytest

    biz = spark.createDataFrame(
        [("B1", 1, dt.date(2026, 3, 1), 2.0, 40.75, -73.9, "Queens", 1), ("B2", 0, dt.date(2025, 1, 1), 0.0, 40.7, -74.0, "Bronx", 2)],
        "business_id string, active int, last_month date, complaint_sum double, latitude double, longitude double, first_borough string, license_count long",
    )
    feats = geojson.geo_feature(biz)
    out = geojson.write_feature_collection(feats, str(tmp_path / "fc"))
    text = "".join(r.value for r in spark.read.text(out).collect())
    doc = json.loads(text)
    assert doc["type"] == "FeatureCollection" and len(doc["features"]) == 2
    with pytest.raises(ValueError):
        geojson.write_feature_collection(feats, str(tmp_path / "fc2"), max_features=1)


def test_map_export_writes_nulls_and_records(spark, tmp_path, monkeypatch):
    from tenure.plans import registry

    meta = spark.createDataFrame(
        [(1, "B1", 40.75, -73.9, "Queens", None), (2, "B1", 40.75, -73.9, "Queens", "7"), (3, "gone", 40.75, -73.9, "Bronx", "8")],
        "record_ordinal long, business_id string, latitude double, longitude double, borough string, license_number string",
    )
    biz = spark.createDataFrame(
        [("B1", 1, None, 2.0, 40.75, -73.9, None, 2)],
        "business_id string, active int, last_month date, complaint_sum double, latitude double, longitude double, first_borough string, license_count long",
    )
    monkeypatch.setattr(registry, "_geo_businesses", lambda spark, sf: biz)
    monkeypatch.setattr(registry, "_geo_inputs", lambda spark, sf: (None, meta))
    props = json.loads(registry.QUERIES["write_geojson"](spark, "").first().value)["properties"]
    assert props["borough"] is None and props["last_month"] is None
    rows = registry.QUERIES["job_geojson"](spark, "").collect()
    records = sorted((json.loads(r.value) for r in rows if r.kind == "license_record"), key=lambda r: r["record_ordinal"])
    assert [(r["business_id"], r["record"]["license_number"]) for r in records] == [("B1", None), ("B1", "7")]
    assert [r.kind for r in rows].count("feature") == 1


def test_pipeline_writes_license_records(spark, tmp_path):
    from tenure.config import ModelSettings
    from tenure.plans.run_pipeline import PipelineConfig, run_pipeline
    from tenure.sources import fixtures

    sf = "/root/testdata/sf0.001"
    cfg = PipelineConfig(output_dir=str(tmp_path / "run"), model=ModelSettings(study_end=dt.date(2001, 1, 1)), stages=("geojson",))
    summary = run_pipeline(fixtures.licenses(spark, sf), fixtures.requests(spark, sf), fixtures.license_metadata(spark, sf), cfg)
    features = [json.loads(r.value)["properties"] for r in spark.read.text(summary["geojson_path"]).collect()]
    records = [json.loads(r.value) for r in spark.read.text(summary["license_records_path"]).collect()]
    assert features and {r["business_id"] for r in records} == {p["business_id"] for p in features}
    assert len(records) == sum(p["license_count"] for p in features)
    assert all(r["record"]["address_zip"] is None for r in records)


def test_both_csv_exports_are_read_back(spark, monkeypatch):
    from tenure.plans import registry

    kind = "unique_key string, complaint_type string, created_date timestamp, latitude double, longitude double"
    rows = [("1", 'Noise, "loud"', dt.datetime(2024, 1, 5, 13, 2, 3), 40.75, -73.9), ("2", "two\nlines", dt.datetime(2024, 2, 5), 40.7, -74.0)]
    monkeypatch.setattr(registry.fixtures, "requests", lambda spark, sf: spark.createDataFrame(rows, kind))
    got = registry.QUERIES["scan_service_requests"](spark, "/root/testdata/sf0.001").orderBy("unique_key").collect()
    assert [tuple(r)[:5] for r in got] == rows


def test_scan_service_requests_matches_its_oracle(spark):
    from tests.tools_check import compare

    assert compare(spark, "/root/testdata/sf0.001", "scan_service_requests")


def test_cox_artifacts_hold_both_models(spark):
    from tenure.plans import registry

    kinds = {r.model for r in registry.QUERIES["write_cox_artifacts"](spark, "/root/testdata/sf0.001").select("model").distinct().collect()}
    assert kinds == {"standard", "time_varying"}


def test_export_map_shuffles_records_once(spark, tmp_path, monkeypatch):
    """Features, records and chunks come from records saved once, in compressed lines, and are what the separate steps give."""
    rows = [(i, f"b{i % 9}" if i < 40 else "big", 40.7, -73.9, "Queens" if i % 2 else "Bronx", f"n{i}") for i in range(90)]
    meta = spark.createDataFrame(rows, "record_ordinal long, business_id string, latitude double, longitude double, borough string, license_number string")
    summary = spark.createDataFrame(
        [(b, dt.date(2020, 1, 1), 1.0, 1) for b in [f"b{i}" for i in range(8)] + ["big", "none"]],
        "business_id string, last_month date, complaint_sum double, active int",
    )
    biz = geojson.join_geo(summary, geojson.business_license_metadata(meta))
    chunks = geojson.license_record_chunks(meta, per_chunk=20)
    feats = geojson.geo_feature(geojson.with_license_records(biz, chunks))
    want = [geojson.write_geojson(feats, str(tmp_path / "f")), geojson.write_license_records(feats, meta, str(tmp_path / "r")), geojson.write_record_chunks(feats, chunks, str(tmp_path / "c"))]
    of, made = geojson.SavedRecords.of, []
    monkeypatch.setattr(geojson.SavedRecords, "of", staticmethod(lambda m: made.append(of(m, per_chunk=20)) or made[-1]))
    _, paths = geojson.export_map(biz, meta, str(tmp_path / "map"))
    for a, b in zip(want, (paths["geojson"], paths["license_records"], paths["record_chunks"])):
        lines = [sorted(r.value for r in spark.read.text(p).collect()) for p in (a, b)]
        assert lines[0] == lines[1] and lines[0]
    assert len(made) == 1 and all(p.suffix == ".gz" for p in (tmp_path / "map").rglob("part-*") if p.suffix != ".crc")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = made[0].whole.groupBy("business_id").agg(F.first("own")).join(made[0].whole, "business_id")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
