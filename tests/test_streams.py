import datetime as dt
import os
import shutil
import time

from pyspark.sql import functions as F

from tenure.operators import cleaning, spatial
from tenure.operators import upsert as U
from tenure.plans.ingest_job import IngestConfig
from tenure.streaming import ingest

CFG = IngestConfig("k", "ts", ("ts",))
BIZ = [("b1", 40.7000, -74.0000), ("b2", 40.7100, -74.0100), ("b3", 40.7000, -74.0000)]


def _land(df, folder, name):
    df.coalesce(1).write.parquet(f"{folder}/{name}")


def _rows(spark, rows):
    return spark.createDataFrame([(k, v, dt.datetime(*t)) for k, v, t in rows], "k string, v string, ts timestamp")


def test_upsert_reads_only_the_months_it_needs(spark, tmp_path):
    root = str(tmp_path / "t")
    table = U.PartitionedTable(spark, root, "k", "ts")
    table.upsert(_rows(spark, [("1", "a", (2024, 1, 5)), ("2", "b", (2024, 2, 5)), ("3", "c", (2024, 3, 5)), ("4", "d", (2024, 3, 6))]))
    broken = os.path.join(root, "part_month=2024-01")
    for name in os.listdir(broken):  # nothing reads January, or it fails
        if name.startswith("part-"):
            with open(os.path.join(broken, name), "wb") as f:
                f.write(b"no parquet")
    assert table.upsert(_rows(spark, [("2", "moved", (2024, 4, 1)), ("5", "new", (2024, 3, 9))])) == 3  # February, March, April
    got = {(r.k, r.v) for m in ("2024-03", "2024-04") for r in table._months({m}).collect()}
    assert got == {("2", "moved"), ("3", "c"), ("4", "d"), ("5", "new")} and not table._present({"2024-02"})
    # a key named for a month that it has left costs a read of what is there
    assert table.upsert(_rows(spark, [("2", "again", (2024, 4, 2))])) == 1
    # a table from before the index gets one
    shutil.rmtree(root + "_keys")
    shutil.rmtree(broken)
    assert table.upsert(_rows(spark, [("3", "up", (2024, 4, 3))])) == 2
    assert sorted((r.k, r.v) for r in table.read().collect()) == [("2", "again"), ("3", "up"), ("4", "d"), ("5", "new")]


def test_stream_ingest_with_late_and_repeated_files(spark, tmp_path):
    land, table = str(tmp_path / "land"), U.PartitionedTable(spark, str(tmp_path / "t"), "k", "ts")
    parts = [
        _rows(spark, [("1", "a", (2024, 3, 5)), ("2", "b", (2024, 3, 6))]),
        _rows(spark, [("1", "late", (2024, 1, 1)), ("3", "c", (2023, 1, 1))]),  # over a year before
        _rows(spark, [("1", "a", (2024, 3, 5)), ("2", "b", (2024, 3, 6))]),  # the first file again
        _rows(spark, [("2", "b2", (2024, 5, 1)), ("2", "b1", (2024, 4, 1))]),
    ]
    seen = None
    for i, df in enumerate(parts):
        _land(df, land, f"{i}")
        q = ingest.stream_ingest_upsert(spark, f"{land}/*", df.schema, str(tmp_path / "t"), str(tmp_path / "c"), CFG, files_per_trigger=1)
        q.awaitTermination()
        seen = df if seen is None else seen.unionByName(df)
    want = sorted((r.k, r.v, r.ts) for r in U.dedupe_latest(seen, "k", "ts").collect())
    assert sorted((r.k, r.v, r.ts) for r in table.read().collect()) == want


def _requests(spark, ids, month):
    rows = [(str(i), dt.datetime(*month, 1 + i % 20, 10), "Noise", 40.7 + (i % 7) * 1e-4, -74.0 + (i % 5) * 1e-4) for i in ids]
    return spark.createDataFrame(rows, "unique_key string, created_date timestamp, complaint_type string, latitude double, longitude double")


def test_stream_counts_late_requests_and_sheds_state(spark, tmp_path):
    biz = spark.createDataFrame(BIZ, "business_id string, business_latitude double, business_longitude double")
    land, root = str(tmp_path / "land"), str(tmp_path / "t")
    held, whole = [], None
    parts = [_requests(spark, range(60), (2024, 3)), _requests(spark, range(60), (2024, 3)), _requests(spark, range(60, 70), (2021, 1)), _requests(spark, range(70, 72), (2024, 3))]
    for i, df in enumerate(parts):
        _land(df, land, f"{i}")
        q = ingest.stream_monthly_complaints(
            spark, f"{land}/*", df.schema, biz, root, str(tmp_path / "c"), files_per_trigger=1, repeat_window="1 second", hot_cell_rows=1)
        q.awaitTermination()
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress and q.lastProgress["stateOperators"] else None)
        if i != 1:  # the second file repeats the first
            whole = df if whole is None else whole.unionByName(df)
        time.sleep(0 if i == 0 else 2.5)
    pairs = spatial.radius_join(biz, cleaning.clean_service_requests(whole), 50.0)
    want = sorted(tuple(r) for r in pairs.groupBy("business_id", "month").agg(F.count("*").alias("n")).collect())
    table = U.PartitionedTable(spark, root, ["business_id", "month"], "_epoch", part_source="month").read()
    assert sorted((r.business_id, r.month, r.total_311) for r in table.collect()) == want and want
    assert max(held) >= 60 and held[-1] < 60


def test_accumulate_adds_an_epoch_once(spark, tmp_path):
    table = U.PartitionedTable(spark, str(tmp_path / "t"), ["b", "month"], "_epoch", part_source="month")
    one = spark.createDataFrame([("x", dt.date(2024, 1, 1), 2), ("x", dt.date(2024, 1, 1), 3), ("y", dt.date(2024, 2, 1), 1)], "b string, month date, n long")
    assert table.accumulate(one, ["n"], 0) == 2
    assert table.accumulate(one, ["n"], 0) == 2  # run again after a failure
    assert table.accumulate(one.where("b = 'x'"), ["n"], 1) == 1
    assert table.accumulate(one.limit(0), ["n"], 2) == 0
    assert sorted((r.b, r.n, r._epoch) for r in table.read().collect()) == [("x", 10, 1), ("y", 1, 0)]


def test_landed_files_do_not_grow_with_the_tasks(spark, tmp_path):
    from tenure.plans.registry import _land_requests

    req = _requests(spark, range(400), (2024, 3)).unionByName(_requests(spark, range(400, 800), (2024, 4)))
    _land_requests(req.repartition(16), str(tmp_path / "land"))
    files = [f for m in ("2024-03", "2024-04") for f in os.listdir(tmp_path / "land" / f"m={m}") if f.endswith(".parquet")]
    assert len(files) == 2
    back = spark.read.schema(req.schema).parquet(str(tmp_path / "land")).select(*req.columns)
    assert back.count() == 800 and back.exceptAll(req).isEmpty()
