import datetime as dt
import json

import pytest

from tenure.operators import geojson
from tenure.sources import readers

MAP = {"A": "a", "B": "b", "C": "c"}


def _write(tmp_path, text, name="x.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_rejects_are_counted_and_short_records_kept(spark, tmp_path):
    path = _write(tmp_path, 'A,B,C\n1,"x, ""y""",2\n3,4\n5,6,7,8\n9,"a,b","c",""\n10,11,12\n')
    read = readers.read_source(spark, path, MAP, ["A"])
    assert [tuple(r) for r in read.rows.collect()] == [("1", 'x, "y"', "2"), ("3", "4", None), ("10", "11", "12")]
    lost = read.rejects.collect()
    assert [(r.record, r.n_fields) for r in lost] == [("5,6,7,8", 4), ('9,"a,b","c",""', 4)]
    with pytest.raises(ValueError):
        readers.read_source(spark, path, MAP, ["D"])


def test_large_quoted_file_is_read_by_many_tasks(spark, tmp_path):
    line = 'k{0},"some, quoted ""text"" of row {0}",z\n'
    path = _write(tmp_path, "A,B,C\n" + "".join(line.format(i) for i in range(40_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert not readers.has_multiline_fields(spark, path)
        rows = readers.read_source_csv(spark, path, MAP, ["A"])
        assert rows.rdd.getNumPartitions() >= 8 and rows.count() == 40_000
        assert readers.read_source_csv(spark, path, MAP, ["A"], multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    broken = _write(tmp_path, 'A,B,C\n1,"two\nlines",3\n', "y.csv")
    assert readers.has_multiline_fields(spark, broken)
    assert readers.read_source_csv(spark, broken, MAP, ["A"]).first().b == "two\nlines"


def test_csv_panel_types_by_exact_name(spark, tmp_path):
    path = _write(tmp_path, "business_id,month,business_latitude,complaint_type_late_fee,location_cluster_lat\n7,2024-01-01,40.5,3,40.25\n")
    kinds = dict(readers.scan_panel(spark, path, "csv").dtypes)
    assert kinds["complaint_type_late_fee"] == "bigint" and kinds["business_latitude"] == kinds["location_cluster_lat"] == "double"


def test_records_are_nested_in_bounded_chunks(spark, tmp_path):
    kind = "record_ordinal long, business_id string, latitude double, longitude double, borough string, license_number string"
    rows = [(i, "big", 40.7, -73.9, "Queens", f"n{i}") for i in range(50)] + [(100 + i, "small", 40.7, -73.9, None, f"m{i}") for i in range(3)]
    meta = spark.createDataFrame(rows, kind)
    biz = spark.createDataFrame(
        [("big", 1, dt.date(2026, 1, 1), 1.0, 40.7, -73.9, "Queens", 50), ("small", 0, None, 0.0, 40.7, -73.9, None, 3), ("none", 0, None, 0.0, 40.7, -73.9, None, 0)],
        "business_id string, active int, last_month date, complaint_sum double, latitude double, longitude double, first_borough string, license_count long",
    )
    chunks = geojson.license_record_chunks(meta, per_chunk=10)
    feats = geojson.geo_feature(geojson.with_license_records(biz, chunks))
    lines = [json.loads(r.value)["properties"] for r in spark.read.text(geojson.write_geojson(feats, str(tmp_path / "f"))).collect()]
    props = {p["business_id"]: p for p in lines}
    assert [r["license_number"] for r in props["small"]["license_records"]] == ["m0", "m1", "m2"] and props["small"]["license_record_chunks"] == 1
    assert props["small"]["license_records"][0]["borough"] is None
    assert props["big"]["license_record_chunks"] == 5 and props["big"]["license_records"] is None and props["none"]["license_records"] is None
    found = [json.loads(r.value) for r in spark.read.text(geojson.write_record_chunks(feats, chunks, str(tmp_path / "c"))).collect()]
    assert {r["business_id"] for r in found} == {"big"} and len(found) == 5
    assert sorted(x["license_number"] for r in found for x in r["license_records"]) == sorted(f"n{i}" for i in range(50))


def test_map_inputs_are_checked(spark):
    meta = spark.createDataFrame([("b", 1.0, 2.0, "Queens")], "business_id string, latitude double, longitude double, borough string")
    panel = spark.createDataFrame([("b", dt.date(2024, 1, 1), 3)], "business_id string, month date, complaint_sum int")
    for bad in ((panel.drop("month"), meta), (panel.drop("complaint_sum"), meta), (panel, meta.drop("borough"))):
        with pytest.raises(ValueError):
            geojson.prepare_geojson_inputs(*bad)


def test_run_needs_its_inputs(spark, tmp_path):
    from tenure.plans.run_pipeline import InputPaths, PipelineConfig, missing_inputs, run_from_paths

    there = _write(tmp_path, "A\n1\n")
    paths = InputPaths(there, str(tmp_path / "gone.csv"), str(tmp_path / "map.csv"))
    assert missing_inputs(spark, paths) == [paths.requests, paths.metadata]
    with pytest.raises(FileNotFoundError, match="gone.csv"):
        run_from_paths(spark, paths, PipelineConfig(output_dir=str(tmp_path / "out")))
    assert not (tmp_path / "out").exists()


def test_exports_are_parsed_once(spark, tmp_path, monkeypatch):
    """The run reads its sources several times, but their text once; the panel is saved by business, not checkpointed row by row."""
    from tenure.config import LICENSE_HEADER_MAP, LICENSE_METADATA_HEADER_MAP, REQUEST_HEADER_MAP
    from tenure.plans import run_pipeline as P
    from tenure.sources import fixtures, readers

    sf, paths = "/root/testdata/sf0.001", []
    for name, df, names in (
        ("licenses", fixtures.licenses(spark, sf), LICENSE_HEADER_MAP),
        ("requests", fixtures.requests(spark, sf), REQUEST_HEADER_MAP),
        ("metadata", fixtures.license_metadata(spark, sf), LICENSE_METADATA_HEADER_MAP),
    ):
        paths.append(readers.write_source_csv(df, str(tmp_path / name), names, {}))
    seen = []
    monkeypatch.setattr(P, "run_pipeline", lambda *args: seen.extend(args) or {})
    P.run_from_paths(spark, P.InputPaths(*paths), P.PipelineConfig(output_dir=str(tmp_path / "out")))
    for df, path in zip(seen, paths):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Format: Parquet" in plan and "Format: CSV" not in plan
        assert df.count() == spark.read.option("header", True).csv(path).count()
