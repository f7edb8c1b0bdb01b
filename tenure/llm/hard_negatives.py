"""Hard negatives by Fagin's threshold algorithm.

Rows are kept in blocks.  For each dimension a block has its rows sorted by
that component; an anchor reads the lists from the top where its own component
is positive and from the bottom where it is negative.  Rows that a list shows for the first time
are scored by random access, an integer inner product.  The threshold is the best score that
a row not shown yet can have: the reading stops once it is strictly below the last place of each
list asked for, so that ties by id are settled among rows that have been seen.

Two searches: the best rows of the anchor's label, then, in the window of scores
that each positive opens, the best rows of other labels.  A block answers
with at most k rows for an anchor and window, which are merged over the blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save


def _integers(df: DataFrame, scale: int) -> DataFrame:
    """``id, label, raw``: floors of the scaled components as int64 bytes, of rows that take part."""

    def run(batches):
        for batch in batches:
            keep, raw = [], []
            for k, x in enumerate(batch.column(2)):
                if not x.is_valid or x.values.null_count:
                    continue
                v = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
                # inner products of two such vectors fit 64 bits (null and non-finite components fail here)
                if np.isfinite(v).all() and (not len(v) or np.abs(v).max() < math.sqrt(2.0**62 / len(v))):
                    keep.append(k)
                    raw.append(v.astype("<i8").tobytes())
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(raw, pa.binary())], ["id", "label", "raw"])

    kinds = dict(df.dtypes)
    return df.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, raw binary")


class Lists:
    """Rows of one block and length, sorted by each component."""

    def __init__(self, vectors: np.ndarray):
        self.whole = vectors
        self.best = np.argsort(-vectors, axis=0, kind="stable").T.copy()  # of each dimension, largest first
        self.reach = int(np.abs(vectors).max(initial=0)) * vectors.shape[1]
        self.as_kind: dict = {}

    def _exact(self, anchor: np.ndarray):
        """The rows and the anchor in the fastest type that sums without rounding."""
        bound = self.reach * int(np.abs(anchor).max(initial=0))
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
        if kind not in self.as_kind:
            self.as_kind[kind] = self.whole.astype(kind)
        return self.as_kind[kind], anchor.astype(kind)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """Per window (lowest and highest score) the first k allowed rows as (score, row), ties by row."""
        rows, a = self._exact(anchor)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        n = len(rows)
        shown = ~allowed
        floor = min(lo for lo, _ in windows)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        depth = 0
        step = max(1, n // 64)
        while not shown.all():
            depth, start = min(n, depth + step), depth
            step *= 2
            before = shown.copy()
            shown[self.best[up, start:depth]] = True
            shown[self.best[down, n - depth : n - start]] = True
            if depth == n:
                shown[:] = True  # an anchor without signs has no lists
            new = np.flatnonzero(shown ^ before)
            scores = rows[new] @ a
            near = scores >= floor
            new, scores = new[near], scores[near].astype(np.int64)
            ends = [self.best[up, depth - 1], self.best[down, n - depth]]
            threshold = int(rows[ends[0], up] @ a[up]) + int(rows[ends[1], down] @ a[down])
            open_ = False
            for w, (lo, hi) in enumerate(windows):
                inside = (scores >= lo) & (scores <= hi)
                s, r = np.r_[found[w][0], scores[inside]], np.r_[found[w][1], new[inside]]
                if len(s) > k:
                    last = np.partition(s, len(s) - k)[len(s) - k]
                    s, r = s[s >= last], r[s >= last]
                    order = np.lexsort((r, -s))[:k]
                    s, r = s[order], r[order]
                found[w] = (s, r)
                open_ |= threshold >= lo and (len(s) < k or threshold >= s.min())
            if not open_:
                break
        out = []
        for s, r in found:
            order = np.lexsort((r, -s))
            out.append(list(zip(s[order].tolist(), r[order].tolist())))
        return out


def _matrix(raw) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), -1)


def _search(blocks: DataFrame, wanted: DataFrame, k: int, same: bool, low: int, high: int) -> DataFrame:
    """``qid, positive_score, score, id``: the best of each block for each query and window.

    ``wanted`` has ``block, chunk, qid, label, raw, scores``; a unit of work is one block and one chunk of queries.
    """
    kinds = dict(blocks.dtypes)

    def run(rows, queries):
        out = []
        rows = rows.sort_values("id", kind="stable")
        size_of_rows, size_of_queries = rows["raw"].str.len(), queries["raw"].str.len()
        for size in sorted(set(size_of_rows) & set(size_of_queries)):
            own = rows[size_of_rows == size]
            ids, labels = own["id"].to_numpy(), own["label"].to_numpy()
            lists = Lists(_matrix(own["raw"]))
            masks: dict = {}
            asked = queries[size_of_queries == size]
            for qid, label, anchor, scores in zip(asked["qid"], asked["label"], _matrix(asked["raw"]), asked["scores"]):
                if label not in masks:
                    masks[label] = labels == label if same else labels != label
                if same:
                    windows = [(None, -(2**63), 2**63 - 1)]
                else:
                    windows = [(int(p), -((-low * int(p)) // 100), (high * int(p)) // 100) for p in scores]
                    windows = [w for w in windows if w[1] <= w[2]]
                if not windows or not masks[label].any():
                    continue
                for w, best in zip(windows, lists.search(anchor, masks[label], [w[1:] for w in windows], k)):
                    out += [(qid, w[0], s, ids[r]) for s, r in best]
        return pd.DataFrame(out, columns=["qid", "positive_score", "score", "id"]).astype({"positive_score": "Int64"})

    units = wanted.select(F.col("block").alias("at"), F.col("chunk").alias("part")).distinct()
    spread = blocks.join(units, F.col("block") == F.col("at")).select("at", "part", "id", "label", "raw").groupBy("at", "part")
    return spread.cogroup(wanted.groupBy("block", "chunk")).applyInPandas(
        lambda rows, queries: run(rows, queries), f"qid long, positive_score long, score long, id {kinds['id']}"
    )


def _first(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    """The first k of each group over all blocks, as a sorted array ``top`` of (order, id)."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    return best.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("top"))


def mine(
    df: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    block: int = 8192,
    chunk: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of the components' floors after scaling, higher first, ties by smaller
    id.  An anchor's positives are its first ``positives`` other rows of its label; a
    positive's negatives are the first rows of other labels that score from ``low`` to ``high``
    percent of it.  ``anchors`` is a condition on columns of ``df``.

    Rows with a null id, label or vector, or a null or non-finite component take no part, nor
    do those whose scores would not fit 64 bits.  Vectors of different length are never
    compared; equal rows count once; rows that share an id but differ are rows of
    their own, and none is the positive of another.  Of rows with equal integers and label only
    the smallest ids can be among the first, so the others are left out of the search, but
    stay anchors.  Other columns are read by ``anchors`` alone; an empty table gives an empty result.
    """
    src = df.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("v"), anchors.alias("anchor")
    ).where("id is not null and label is not null and v is not null")
    marked = src.groupBy("id", "label", "v").agg(F.max(F.coalesce("anchor", F.lit(False))).alias("anchor"))
    rows = _integers(marked.select("id", F.struct("label", "anchor").alias("label"), "v"), scale)
    rows = save(rows.select("id", "label.label", "label.anchor", "raw"), "negatives-rows")
    kinds = dict(rows.dtypes)
    shape = rows.agg(F.count("*").alias("n"), F.max(F.length("raw")).alias("size"), F.sum(F.col("anchor").cast("long")).alias("anchors")).first()
    spark = df.sparkSession
    if not shape["anchors"]:
        return spark.createDataFrame(
            [], f"anchor_id {kinds['id']}, positive_id {kinds['id']}, rank int, negative_id {kinds['id']}, positive_score long, negative_score long"
        )

    # the smallest ids of each vector and label: the limit is applied before the shuffle, too
    copies = Window.partitionBy("raw", "label").orderBy("id")
    most = max(positives + 1, negatives)
    kept = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= most).select("id", "label", "raw")
    # a block is a range of labels, a frequent label many blocks; wide vectors come in smaller blocks
    height = max(64, min(block, (1 << 19) // max(1, shape["size"] // 8)))
    n_blocks = math.ceil(shape["n"] / height)
    blocks = kept.repartitionByRange(n_blocks, "label", F.xxhash64("raw"), "id").withColumn("block", F.spark_partition_id())
    blocks = save(blocks, "negatives-blocks")
    held = blocks.groupBy("block", "label").agg(F.count("*").alias("n"))

    n_chunks = math.ceil(shape["anchors"] / chunk)
    queries = rows.where("anchor").select("label", "raw").distinct().withColumn("qid", F.monotonically_increasing_id())
    queries = save(queries.withColumn("chunk", F.pmod(F.xxhash64("qid"), F.lit(n_chunks))), "negatives-queries")
    owners = rows.where("anchor").join(queries, ["raw", "label"]).select(F.col("id").alias("anchor_id"), "qid")

    wanted = queries.join(held.select("block", "label"), "label").withColumn("scores", F.array().cast("array<long>"))
    wanted = wanted.select("block", "chunk", "qid", "label", "raw", "scores")
    near = _first(_search(blocks, wanted, positives + 1, True, low, high), positives + 1, ["qid"])
    others = F.slice(F.filter("top", lambda x: x["id"] != F.col("anchor_id")), 1, positives)
    pairs = owners.join(near, "qid").select("anchor_id", "qid", F.explode(others).alias("p"))
    pairs = save(pairs.select("anchor_id", "qid", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score")), "negatives-pairs")

    # at most `positives + 1` different scores a query
    opened = pairs.groupBy("qid").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    last = blocks.agg(F.max("block")).first()[0]
    wanted = queries.join(opened, "qid").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last))))
    wanted = wanted.select("block", "chunk", "qid", "label", "raw", "scores")
    far = _first(_search(blocks, wanted, negatives, False, low, high), negatives, ["qid", "positive_score"])
    out = pairs.join(far, ["qid", "positive_score"]).select("anchor_id", "positive_id", F.explode("top").alias("x"), "positive_score")
    return out.select(
        "anchor_id",
        "positive_id",
        F.col("x.n").alias("rank"),
        F.col("x.id").alias("negative_id"),
        "positive_score",
        F.col("x.score").alias("negative_score"),
    )
