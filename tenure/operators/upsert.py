"""Incremental ingest and keyed upsert without a table format.

* ``high_watermark``: max timestamp truncated to the day (fallback: first of
  the current month).
* ``incremental_source``: all rows strictly after the watermark.
* ``source_page``: one ordered page of the landing rows after a
  (timestamp, key) cursor, for callers that want a bounded run.
* ``dedupe_latest``: one row per key, the latest by timestamp (``max_by``
  with map-side partial aggregation; a hot key never lands whole in a task).
* ``upsert``: target rows whose key is not in the source, plus the source
  (anti-join + union: MERGE update-all / insert-all).
* ``PartitionedTable``: the large-table layout, partitioned by the month of
  a timestamp.  An index beside it says in which months a key may stand, so an
  upsert reads and rewrites only the months that the batch falls in or that
  hold its keys.  There is no atomic commit over several months: a failed run is
  repeated whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _timestamp(df: DataFrame, column: str) -> Column:
    """The column as a timestamp; unreadable text is NULL."""
    c = F.col(column)
    return F.try_to_timestamp(c) if df.schema[column].dataType.simpleString() == "string" else c.cast("timestamp")


def high_watermark(target: DataFrame, ts_col: str) -> DataFrame:
    """One row: ``watermark`` = day-truncated max(ts), or the first of the
    current month when the table is empty."""
    fallback = F.trunc(F.current_date(), "month").cast("timestamp")
    return target.agg(F.coalesce(F.date_trunc("day", F.max(F.col(ts_col).cast("timestamp"))), fallback).alias("watermark"))


def incremental_source(landing: DataFrame, ts_col: str, watermark) -> DataFrame:
    """All landing rows after the watermark, however many share a day."""
    return landing.where(_timestamp(landing, ts_col) > F.lit(watermark).cast("timestamp"))


def source_page(landing: DataFrame, ts_col: str, key_col: str, size: int, after: tuple | None = None) -> DataFrame:
    """The next ``size`` rows by (timestamp, key) after the cursor ``after``.

    The cursor is the last row's pair, so a day or a timestamp with more rows
    than a page is read over several pages and never skipped.
    """
    ts = _timestamp(landing, ts_col)
    rows = landing.where(ts.isNotNull())
    if after:
        at = F.lit(after[0]).cast("timestamp")
        rows = rows.where((ts > at) | (ts == at) & (F.col(key_col) > F.lit(after[1])))
    return rows.orderBy(ts, F.col(key_col)).limit(size)


def align_to_schema(df: DataFrame, columns: list[str], timestamp_cols=()) -> DataFrame:
    """Target column order; missing columns NULL, extra dropped; strings
    except the timestamp columns (unreadable -> NULL)."""
    out = []
    for c in columns:
        if c not in df.columns:
            v = F.lit(None).cast("timestamp" if c in timestamp_cols else "string")
        else:
            v = _timestamp(df, c) if c in timestamp_cols else F.col(c).cast("string")
        out.append(v.alias(c))
    return df.select(*out)


def to_timestamp_cols(df: DataFrame, cols, pattern: str | None = None) -> DataFrame:
    """Cast named string columns to timestamps (unparseable -> NULL)."""
    for c in cols:
        if c in df.columns:
            v = F.col(c).cast("string")
            df = df.withColumn(c, F.try_to_timestamp(v, F.lit(pattern)) if pattern else F.try_to_timestamp(v))
    return df


def dedupe_latest(df: DataFrame, key_col, ts_col: str) -> DataFrame:
    """Latest row per key (a column or a list; ties: larger struct wins,
    deterministic)."""
    keys = [key_col] if isinstance(key_col, str) else list(key_col)
    others = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(F.col(ts_col), F.struct(*others))).alias("_r"))
    return latest.select(*keys, "_r.*").select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, key_col) -> DataFrame:
    """MERGE on key (a column or a list): update all matched, insert all unmatched."""
    keys = [key_col] if isinstance(key_col, str) else list(key_col)
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source.select(*target.columns))


def first_of_month(today: dt.date | None = None) -> dt.datetime:
    today = today or dt.date.today()
    return dt.datetime(today.year, today.month, 1)


class PartitionedTable:
    """Parquet table partitioned by ``part_col``, the month of ``part_source``.

    Rows without that timestamp live in a partition of their own.  On a key
    match the batch's row replaces the stored one; with ``latest_wins`` only
    if its ``ts_col`` is not earlier (for streams, whose files come in any order; at
    equal timestamps the later batch wins).  Within a batch the latest row
    of a key counts.  A key that moves to another month leaves the old one.

    The index (``<root>_keys``) holds (key, month) in ``buckets`` by the key's
    hash.  It is only appended to, before the months are written, so it
    names all months of a key and perhaps some that the key has left; those
    cost a read and no more.  A batch reads the buckets of its keys.  A
    table without one gets it from its stored keys once.
    """

    NO_MONTH = "none"

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key_col,
        ts_col: str,
        part_col: str = "part_month",
        part_source: str | None = None,
        latest_wins: bool = False,
        buckets: int = 64,
    ):
        self.buckets = buckets
        self.spark, self.root = spark, root.rstrip("/")
        self.keys = [key_col] if isinstance(key_col, str) else list(key_col)
        self.ts_col, self.part_col, self.latest_wins = ts_col, part_col, latest_wins
        self.part_source = part_source or ts_col
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(conf)
        self._path = jvm.org.apache.hadoop.fs.Path

    def exists(self) -> bool:
        """True once at least one partition directory has been committed."""
        root = self._path(self.root)
        if not self._fs.exists(root):
            return False
        prefix = self.part_col + "="
        return any(st.isDirectory() and st.getPath().getName().startswith(prefix) for st in self._fs.listStatus(root))

    def _stored(self) -> DataFrame:
        df = self.spark.read.option("basePath", self.root).parquet(self.root)
        return df.withColumn(self.part_col, F.col(self.part_col).cast("string"))

    def read(self) -> DataFrame:
        return self._stored().drop(self.part_col)

    def _with_part(self, df: DataFrame) -> DataFrame:
        month = F.date_format(F.col(self.part_source), "yyyy-MM")
        return df.withColumn(self.part_col, F.coalesce(month, F.lit(self.NO_MONTH)))

    @property
    def index_root(self) -> str:
        return f"{self.root}_keys"

    def _index_rows(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.select(*self.keys, F.col(self.part_col).alias("held_in"), bucket.alias("bucket"))

    def _append_index(self, rows: DataFrame) -> None:
        (
            self._index_rows(rows).distinct().repartition("bucket").write.mode("append").partitionBy("bucket").parquet(self.index_root)
        )

    def _months_of(self, src: DataFrame) -> set[str]:
        """Months that may hold keys of the batch, from the batch's buckets of the index."""
        if not self._fs.exists(self._path(f"{self.index_root}/_SUCCESS")):
            self._append_index(self._stored())
        wanted = self._index_rows(src).select(*self.keys, "bucket")
        buckets = sorted(r[0] for r in wanted.select("bucket").distinct().collect())
        index = self.spark.read.option("basePath", self.index_root).parquet(self.index_root).where(F.col("bucket").isin(buckets))
        held = index.join(wanted.drop("bucket"), self.keys, "left_semi").select("held_in").distinct()
        there = {r[0] for r in held.collect()}
        return {m for m in there if self._fs.exists(self._path(f"{self.root}/{self.part_col}={m}"))}

    def _months(self, months: set[str]) -> DataFrame:
        """The stored rows of some months; only their folders are read."""
        paths = [f"{self.root}/{self.part_col}={m}" for m in sorted(months)]
        df = self.spark.read.option("basePath", self.root).parquet(*paths)
        return df.withColumn(self.part_col, F.col(self.part_col).cast("string"))

    def _replace(self, merged: DataFrame, months: set[str]) -> None:
        """Write the new rows of ``months`` over the stored ones."""
        from tenure.operators.sampling import _checkpoint

        # lineage cut: the write below must not read the paths it replaces;
        # a month is spread over tasks by its keys
        merged = _checkpoint(merged.repartition(self.part_col, *self.keys))
        left = {r[0] for r in merged.select(self.part_col).distinct().collect()}
        (
            merged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.part_col)
            .parquet(self.root)
        )
        for month in months - left:  # all their keys have moved
            self._fs.delete(self._path(f"{self.root}/{self.part_col}={month}"), True)

    def _present(self, months: set[str]) -> set[str]:
        return {m for m in months if self._fs.exists(self._path(f"{self.root}/{self.part_col}={m}"))}

    def accumulate(self, source: DataFrame, columns: list[str], epoch: int) -> int:
        """Add the numbers in ``columns`` to those stored under the same keys;
        returns the number of months rewritten.

        The month must be one of the keys.  ``ts_col`` holds the last epoch
        added to a row, and an epoch that is repeated changes nothing, so a
        failed batch may be run again whole.
        """
        from tenure.operators.sampling import _checkpoint

        src = source.groupBy(*self.keys).agg(*[F.sum(c).cast("long").alias(c) for c in columns])
        src = _checkpoint(self._with_part(src.withColumn(self.ts_col, F.lit(epoch).cast("long"))))
        months = {r[0] for r in src.select(self.part_col).distinct().collect()}
        if not months:
            return 0
        both = src.withColumn("_new", F.lit(1))
        if present := self._present(months):
            stored = self._months(present)
            both = both.unionByName(stored.select(*src.columns).withColumn("_new", F.lit(0)))
        old, new = F.col("_new") == 0, F.col("_new") == 1
        before = F.max(F.when(old, F.col(self.ts_col)))
        sums = [
            (F.coalesce(F.sum(F.when(old, F.col(c))), F.lit(0)) + F.when(F.coalesce(before >= epoch, F.lit(False)), 0)
             .otherwise(F.coalesce(F.sum(F.when(new, F.col(c))), F.lit(0)))).alias(c)
            for c in columns
        ]
        merged = both.groupBy(*self.keys, self.part_col).agg(*sums, F.max(self.ts_col).alias(self.ts_col)).select(*src.columns)
        self._replace(merged, months)
        return len(months)

    def upsert(self, source: DataFrame) -> int:
        """Merge ``source``; returns the number of months rewritten."""
        from tenure.operators.sampling import _checkpoint

        src = _checkpoint(self._with_part(dedupe_latest(source, self.keys, self.ts_col)))
        months = {r[0] for r in src.select(self.part_col).distinct().collect()}
        if not months:
            return 0
        if self.exists():
            months |= self._months_of(src)
            self._append_index(src)
            columns = src.columns
            both = src.withColumn("_batch", F.lit(1))
            if present := self._present(months):
                target = self._months(present)
                columns = target.columns
                both = target.withColumn("_batch", F.lit(0)).unionByName(src.select(*columns).withColumn("_batch", F.lit(1)))
            others = [c for c in both.columns if c not in self.keys]
            rank = F.struct(F.col(self.ts_col), F.col("_batch")) if self.latest_wins else F.col("_batch")
            newest = both.groupBy(*self.keys).agg(F.max_by(F.struct(*others), rank).alias("_r"))
            merged = newest.select(*self.keys, "_r.*").select(*columns)
        else:
            self._append_index(src)
            merged = src
        self._replace(merged, months)
        return len(months)
