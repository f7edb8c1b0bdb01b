"""Structured Streaming twins of the incremental jobs.

* ``stream_ingest_upsert``: landing files -> rows that have just arrived once
  already are dropped -> per micro-batch align / cast -> latest-timestamp-wins
  merge into a month-partitioned table, reading and rewriting only the months the
  batch's rows and keys stand in (files may arrive out of order).
* ``stream_monthly_complaints``: landing request files -> cleaning -> repeated
  rows dropped -> per micro-batch counts around the saved business sites (the batch
  operators, hot cells split) -> added to a month-partitioned table.

Repeated rows are found by a hash of the whole row, kept in state for
``repeat_window`` after its arrival (``dropDuplicatesWithinWatermark``).  The watermark
runs on arrival time and not on the rows' own timestamps, so no row is ever late:
a request of any month is counted, and the state holds what arrived lately and
shrinks again.  Re-running a batch after a failure gives the same tables; the
checkpoint records consumed files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tenure.operators import cleaning, spatial
from tenure.operators import upsert as U
from tenure.plans.ingest_job import IngestConfig


def _file_stream(spark: SparkSession, landing_dir: str, schema: StructType, files_per_trigger: int) -> DataFrame:
    # columns found in folder names are not part of the rows
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing_dir).select(*schema.names)


def _without_repeats(rows: DataFrame, window: str) -> DataFrame:
    """Rows not seen within ``window`` of their first arrival."""
    columns = rows.columns
    marked = rows.withColumn("_arrived", F.current_timestamp()).withColumn("_row", F.sha2(F.to_json(F.struct(*columns)), 256))
    return marked.withWatermark("_arrived", window).dropDuplicatesWithinWatermark(["_row"]).select(*columns)


def stream_ingest_upsert(
    spark: SparkSession,
    landing_dir: str,
    schema: StructType,
    table_root: str,
    checkpoint_dir: str,
    cfg: IngestConfig,
    files_per_trigger: int = 8,
    repeat_window: str = "1 day",
) -> StreamingQuery:
    table = U.PartitionedTable(spark, table_root, cfg.key, cfg.ts_col, latest_wins=True)

    def batch(df: DataFrame, epoch_id: int) -> None:
        columns = table.read().columns if table.exists() else df.columns
        src = U.align_to_schema(df, columns, cfg.timestamp_cols)
        # files arrive in any order: the latest timestamp wins, at a tie the later batch
        table.upsert(src)

    rows = _without_repeats(_file_stream(spark, landing_dir, schema, files_per_trigger), repeat_window)
    return (
        rows.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def stream_monthly_complaints(
    spark: SparkSession,
    landing_dir: str,
    schema: StructType,
    locations: DataFrame,
    table_root: str,
    checkpoint_dir: str,
    radius_meters: float = 50.0,
    files_per_trigger: int = 8,
    repeat_window: str = "1 day",
    hot_cell_rows: int = 200_000,
) -> StreamingQuery:
    table = U.PartitionedTable(spark, table_root, ["business_id", "month"], "_epoch", part_source="month")
    sites = spatial.BusinessSites(locations, radius_meters, hot_cell_rows)  # saved once for all micro-batches
    requests = cleaning.clean_service_requests(_file_stream(spark, landing_dir, schema, files_per_trigger))

    def batch(df: DataFrame, epoch_id: int) -> None:
        # an epoch that is run again adds nothing twice
        table.accumulate(sites.counts(df).withColumnRenamed("n", "total_311"), ["total_311"], epoch_id)

    return (
        _without_repeats(requests, repeat_window)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
