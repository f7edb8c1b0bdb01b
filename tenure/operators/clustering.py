"""Location clusters: KMeans over business coordinates.

The best of 20 seeded restarts is kept, as in the reference.  All restarts run
together: the centres of every restart are held on the driver (restarts x k
pairs of numbers), and each step is one job that assigns every point to its nearest
centre of each restart and adds weights and coordinates per (restart, centre),
partial sums per partition first.  A restart whose centres have settled is
left out of further steps.  Points are few bytes but much work (restarts x k distances
each), so they are spread by their number, ``task_points`` a task, neighbours together: a block of 64
whose box has one nearest centre is added whole (Kanungo's filter), the others' points are compared with
the centres that their box leaves over.

Starts are k-means++ draws on a bounded sample (``sample`` distinct points of
smallest hash), refined on that sample; the steps that decide run over all points.
If there are fewer businesses than clusters, every business is cluster 0 at
the coordinate mean.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.operators.sampling import _checkpoint
from tenure.operators.spatial import nearest_centroid

_CHUNK = 8192


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest centre (ties: the first)."""
    d = (x[:, :1] - centres[None, :, 0]) ** 2 + (x[:, 1:] - centres[None, :, 1]) ** 2
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def _sums(x: np.ndarray, w: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per centre: weight, weighted coordinates, weighted squared distance."""
    out = np.zeros((len(centres), 4))
    for at in range(0, len(x), _CHUNK):
        part, weight = x[at : at + _CHUNK], w[at : at + _CHUNK]
        best, d = _nearest(part, centres)
        for i, v in enumerate((weight, weight * part[:, 0], weight * part[:, 1], weight * d)):
            out[:, i] += np.bincount(best, weights=v, minlength=len(centres))
    return out


def _moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Centres at the means of their points; one without points stays."""
    has = sums[:, 0] > 0
    return np.where(has[:, None], sums[:, 1:3] / np.where(has, sums[:, 0], 1.0)[:, None], centres)


def _start(x: np.ndarray, w: np.ndarray, k: int, rng: np.random.Generator, steps: int = 30) -> np.ndarray:
    """k-means++ centres, each the best of a few draws, then Lloyd steps."""
    tries = 2 + int(np.log(k))
    centres = [x[rng.choice(len(x), p=w / w.sum())]]
    near = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        mass = near * w
        p = mass / mass.sum() if mass.sum() > 0 else w / w.sum()
        drawn = rng.choice(len(x), size=tries, p=p)
        left = [np.minimum(near, ((x - x[i]) ** 2).sum(axis=1)) for i in drawn]
        best = int(np.argmin([(v * w).sum() for v in left]))
        centres.append(x[drawn[best]])
        near = left[best]
    out = np.array(centres)
    for _ in range(steps):
        new = _moved(out, _sums(x, w, out))
        if np.allclose(new, out, rtol=0, atol=0):
            break
        out = new
    return out


class _Blocks:
    """Points in blocks of neighbours in the file: a block that lies nearest to one centre whole
    is added by its sums, and points of the others are compared with the centres that may be nearest."""

    def __init__(self, x: np.ndarray, w: np.ndarray, size: int = 64):
        n = -(-len(x) // size)
        fill = n * size - len(x)  # copies of the last point, without weight
        self.x = np.concatenate([x, np.repeat(x[-1:], fill, axis=0)]).reshape(n, size, 2)
        self.w = np.concatenate([w, np.zeros(fill)]).reshape(n, size)
        self.low, self.high = self.x.min(axis=1), self.x.max(axis=1)
        self.weight = self.w.sum(axis=1)
        self.mean = (self.x * self.w[:, :, None]).sum(axis=1) / self.weight[:, None]
        self.cost = (((self.x - self.mean[:, None]) ** 2).sum(axis=2) * self.w).sum(axis=1)

    def sums(self, centres: np.ndarray) -> np.ndarray:
        """``_sums`` of the points."""
        k = len(centres)
        to_low, to_high = self.low[:, None] - centres, centres - self.high[:, None]
        least = (np.maximum(0.0, np.maximum(to_low, to_high)) ** 2).sum(axis=2)
        most = (np.maximum(np.abs(to_low), np.abs(to_high)) ** 2).sum(axis=2).min(axis=1)
        may = least <= most[:, None] * (1 + 1e-9)
        many = may.sum(axis=1)
        out = np.zeros((k, 4))
        own = np.flatnonzero(many == 1)
        best, mean, weight = may[own].argmax(axis=1), self.mean[own], self.weight[own]
        away = ((mean - centres[best]) ** 2).sum(axis=1) * weight + self.cost[own]
        for i, v in enumerate((weight, weight * mean[:, 0], weight * mean[:, 1], away)):
            out[:, i] += np.bincount(best, weights=v, minlength=k)
        open_ = np.argsort(many, kind="stable")[(many <= 1).sum() :]  # those of as many centres together
        bounds = np.searchsorted(many[open_], (3, 5, 9))
        for at in (x for part in np.split(open_, bounds) for x in np.array_split(part, 1 + len(part) // 512)):
            if not len(at):
                continue
            widest = many[at].max()
            which = np.argsort(~may[at], axis=1, kind="stable")[:, :widest]  # by number, so that ties go to the first
            which = np.where(np.arange(widest) < many[at, None], which, which[:, :1])
            c = centres[which][:, None]
            d = (self.x[at, :, None, 0] - c[..., 0]) ** 2 + (self.x[at, :, None, 1] - c[..., 1]) ** 2
            nearest = d.argmin(axis=2)
            far = np.take_along_axis(d, nearest[:, :, None], axis=2)[:, :, 0]
            best = np.take_along_axis(which, nearest, axis=1).ravel()
            w = self.w[at]
            for i, v in enumerate((w, w * self.x[at, :, 0], w * self.x[at, :, 1], w * far)):
                out[:, i] += np.bincount(best, weights=v.ravel(), minlength=k)
        return out


def _step(points: DataFrame, centres: dict[int, np.ndarray], origin: np.ndarray) -> dict[int, np.ndarray]:
    """One job: the sums of every restart's centres over all points."""

    def part(batches):
        total = {r: np.zeros((len(c), 4)) for r, c in centres.items()}
        held, n = [], 0

        def add():
            x = np.concatenate(held)
            blocks = _Blocks(x[:, :2] - origin, x[:, 2])
            for r, c in centres.items():
                total[r] += blocks.sums(c)

        for pdf in batches:
            held.append(pdf[["a", "b", "w"]].to_numpy(dtype=float))
            n += len(pdf)
            if n >= 1 << 15:
                add()
                held, n = [], 0
        if n:
            add()
        rows = [(r, i, *v) for r, m in total.items() for i, v in enumerate(m.tolist()) if v[0]]
        yield pd.DataFrame(rows, columns=["r", "i", "w", "sa", "sb", "cost"])

    partial = points.mapInPandas(part, "r int, i int, w double, sa double, sb double, cost double")
    out = {r: np.zeros((len(c), 4)) for r, c in centres.items()}
    for row in partial.groupBy("r", "i").agg(*[F.sum(c).alias(c) for c in ("w", "sa", "sb", "cost")]).collect():
        out[row["r"]][row["i"]] = row[2:]
    return out


def fit_location_clusters(
    locations: DataFrame,
    k: int,
    restarts: int = 20,
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
    sample: int = 8192,
    task_points: int = 100_000,
) -> list[tuple[int, float, float]]:
    """Cluster centres [(cluster_id, lat, lng)] for ``locations``
    (business_latitude, business_longitude).  Empty input -> [].
    ``tol`` is relative to the mean coordinate variance, as in the
    reference's clustering: a restart has settled once the summed squared shift of
    its centres is no more."""
    coords = locations.select(F.col("business_latitude").cast("double").alias("a"), F.col("business_longitude").cast("double").alias("b"))
    coords = coords.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    # Businesses sharing a coordinate become one weighted point: the KMeans
    # objective and its Lloyd steps are identical, the input is smaller.
    points = _checkpoint(coords.groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("w")))
    total = F.sum("w")
    mean = points.agg(F.count(F.lit(1)).alias("points"), F.min("a").alias("low"), F.max("a").alias("high"), total.alias("n"), (F.sum(F.col("a") * F.col("w")) / total).alias("a"), (F.sum(F.col("b") * F.col("w")) / total).alias("b")).first()
    if not mean["n"]:
        return []
    if mean["n"] < k:
        return [(0, float(mean["a"]), float(mean["b"]))]
    tasks = -(-mean["points"] // task_points)
    # in strips of a, by b: points that follow each other are neighbours, and the blocks of a step small
    strips = max(1.0, (mean["points"] / 64) ** 0.5)
    strip = F.floor((F.col("a") - F.lit(float(mean["low"]))) * F.lit(strips / max(mean["high"] - mean["low"], 1e-300)))
    points = _checkpoint(points.repartitionByRange(tasks, strip, "b").sortWithinPartitions(strip, "b"))
    origin = np.array([mean["a"], mean["b"]])
    spread = points.agg(*[(F.sum(F.pow(F.col(c) - F.lit(float(m)), 2) * F.col("w")) / total).alias(c) for c, m in zip("ab", origin)]).first()
    limit = tol * (spread["a"] + spread["b"]) / 2.0

    drawn = points.orderBy(F.xxhash64("a", "b", F.lit(seed)), "a", "b").limit(max(sample, k)).collect()
    x, w = np.array([(r["a"], r["b"]) for r in drawn]) - origin, np.array([r["w"] for r in drawn])
    if len(x) <= k:  # no more coordinates than clusters
        return [(i, float(a + origin[0]), float(b + origin[1])) for i, (a, b) in enumerate(sorted(x.tolist()))]
    centres = {r: _start(x, w, k, np.random.default_rng(seed + r)) for r in range(max(1, restarts))}
    settled: dict[int, np.ndarray] = {}
    for _ in range(max_iter):
        sums = _step(points, centres, origin)
        moved = {r: _moved(c, sums[r]) for r, c in centres.items()}
        for r, c in list(moved.items()):
            if ((c - centres[r]) ** 2).sum() <= limit:
                settled[r] = moved.pop(r)
        centres = moved
        if not centres:
            break
    settled.update(centres)
    cost = {r: m[:, 3].sum() for r, m in _step(points, settled, origin).items()}
    best = settled[min(cost, key=lambda r: (cost[r], r))] + origin
    return [(i, float(a), float(b)) for i, (a, b) in enumerate(sorted(best.tolist()))]


def assign_location_clusters(locations: DataFrame, centres: list[tuple[int, float, float]]) -> DataFrame:
    """Attach location_cluster (int), location_cluster_lat, location_cluster_lng
    by nearest centre (KMeans assignment rule: squared Euclidean distance)."""
    if not centres:
        return (
            locations.withColumn("location_cluster", F.lit(None).cast("int"))
            .withColumn("location_cluster_lat", F.lit(None).cast("double"))
            .withColumn("location_cluster_lng", F.lit(None).cast("double"))
        )
    out = nearest_centroid(locations, "business_latitude", "business_longitude", centres)
    return out.withColumn("location_cluster", F.col("location_cluster").cast("int"))


def clustering_cost(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the assigned centre (one row)."""
    return assigned.agg(
        F.sum(
            F.pow(F.col("business_latitude") - F.col("location_cluster_lat"), 2)
            + F.pow(F.col("business_longitude") - F.col("location_cluster_lng"), 2)
        ).alias("cost")
    )
