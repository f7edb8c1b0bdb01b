"""Exact-size seeded sampling without global windows.

* ``dense_index``: a 0..n-1 row index in a hash order, from a range
  partitioning plus per-partition counts (one row per partition reaches the
  driver), so no single task sees all rows.
* ``balance_oversample``: the minority class drawn with replacement up to the
  majority size.  Rows are indexed in the order of md5(keys:seed), and draw d picks
  the row at the number in md5(d:seed) modulo n, so any engine with md5 repeats it;
  draws are counted per picked row with map-side partial aggregation and the
  copies are generated in chunks, so even a one-row minority does not put all
  copies in one task.
* ``stratified_split``: per-class exact test counts; rows ranked by a seeded
  hash within their class through the same dense index.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPY_CHUNK = 100_000


def _checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (lineage cut that
    survives executor loss)."""
    from tenure.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet below ``spark.checkpoint.dir`` and read back:
    for frames with a row per business-month, whose columns take a small part of
    a checkpoint's bytes and are read one by one."""
    import uuid

    from tenure.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _saved_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``_saved``, as a table whose files each hold one hash bucket of ``key``: what
    groups, windows or joins by it reads whole groups from the files and shuffles none
    of the rows.  The table stays in the session's catalog."""
    import uuid

    from tenure.session import ensure_checkpoint_dir

    spark = df.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    # a task of rows spread by ``key`` has one bucket: with a second writer at hand they are not sorted for it
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "2")
    try:
        df.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(table)
    finally:
        spark.conf.set(setting, before)
    return spark.table(table)


def dense_index(df: DataFrame, order_cols: list[str], idx_col: str = "_idx") -> DataFrame:
    """Add ``idx_col`` = 0-based position of each row in ``order_cols`` order."""
    ranged = (
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = _checkpoint(ranged)
    parts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.min("_mid").alias("m0")).collect()
    offset, shift = 0, []
    for r in sorted(parts, key=lambda r: r["_pid"]):
        shift.append((r["_pid"], offset - r["m0"]))
        offset += r["n"]
    shifts = df.sparkSession.createDataFrame(shift, "_pid int, _shift long")  # one row a partition
    return ranged.join(shifts, "_pid").withColumn(idx_col, F.col("_mid") + F.col("_shift")).drop("_pid", "_mid", "_shift")


def row_order(key_cols: list[str], seed: int):
    """md5 of a row's keys and the seed (null keys are left out)."""
    return F.md5(F.concat_ws(":", *[F.col(f"`{c}`").cast("string") for c in key_cols], F.lit(str(seed))).cast("binary"))


def draw_number(draw, seed: int):
    """A number below 2^60 from md5(draw:seed)."""
    digest = F.md5(F.concat_ws(":", draw.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def balance_oversample(df: DataFrame, label: str, key_cols: list[str], seed: int) -> DataFrame:
    """Majority rows (``_copy`` = -1) ∪ exactly n_majority minority draws
    (``_copy`` = copy number within the drawn row).  Tied classes are
    already balanced and returned as they are."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        raise ValueError(f"balancing needs rows of two classes; {label} has {sorted(counts, key=str)}")
    (maj, n_maj), (mino, n_min) = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    base = df.withColumn("_copy", F.lit(-1).cast("long"))
    if n_maj == n_min:
        return base
    majority = base.where(F.col(label) == F.lit(maj))
    minority = df.where(F.col(label) == F.lit(mino)).withColumn("_h", row_order(key_cols, seed))
    indexed = dense_index(minority, ["_h", *key_cols])
    spark = df.sparkSession
    draws = (
        spark.range(n_maj)
        .select((draw_number(F.col("id"), seed) % F.lit(n_min)).alias("_idx"))
        .groupBy("_idx")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    chunks = (
        indexed.join(draws, "_idx", "inner")
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_n") / F.lit(COPY_CHUNK)) - 1)))
        .repartition("_idx", "_chunk")
    )
    copies = chunks.withColumn(
        "_copy",
        F.explode(
            F.sequence(
                F.col("_chunk") * F.lit(COPY_CHUNK),
                F.least((F.col("_chunk") + 1) * F.lit(COPY_CHUNK), F.col("_n")) - 1,
            )
        ),
    ).drop("_idx", "_h", "_n", "_chunk")
    return majority.unionByName(copies.select(*majority.columns))


def stratified_allocation(counts: dict, test_size: float) -> dict:
    """Exact per-class test counts summing to ceil(test_size * n): floor of
    the proportional share, remainder to the largest fractional parts."""
    n = sum(counts.values())
    n_test = int(math.ceil(test_size * n))
    n_train = n - n_test
    train = {}
    rema = []
    for lab, c in sorted(counts.items()):
        share = n_train * c / n
        train[lab] = int(math.floor(share))
        rema.append((share - train[lab], lab))
    left = n_train - sum(train.values())
    for _, lab in sorted(rema, key=lambda t: (-t[0], t[1]))[:left]:
        train[lab] += 1
    return {lab: counts[lab] - train[lab] for lab in counts}


def stratified_split(df: DataFrame, label: str, key_cols: list[str], test_size: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exact per-class sizes; membership by seeded hash rank."""
    counts = class_counts(df, label)
    test_n = stratified_allocation(counts, test_size)
    ordered = df.withColumn("_h", row_order(key_cols, seed + 1))
    indexed = dense_index(ordered, [label, "_h", *key_cols])
    start, acc = {}, 0
    for lab in sorted(counts):
        start[lab] = acc
        acc += counts[lab]
    start_map = F.create_map(*[x for lab, s in start.items() for x in (F.lit(lab), F.lit(s).cast("long"))])
    test_map = F.create_map(*[x for lab, t in test_n.items() for x in (F.lit(lab), F.lit(t).cast("long"))])
    flagged = indexed.withColumn("_test", (F.col("_idx") - start_map[F.col(label)]) < test_map[F.col(label)])
    flagged = flagged.drop("_idx", "_h")
    return flagged.where(~F.col("_test")).drop("_test"), flagged.where(F.col("_test")).drop("_test")
