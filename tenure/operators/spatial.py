"""Spatial operators: grid radius join, nearest centroid, clamping.

Radius join (haversine distance <= r)
-------------------------------------
A plain distance predicate plans as a nested-loop join.  Instead both sides
get a grid cell: cell height is the angular radius (in degrees) and cell width
is the largest longitude span two points within the radius can have at the
data's highest absolute latitude.  Businesses are replicated to their 3x3
neighbourhood, requests stay in their own cell, the equi-join runs on the
cell, and the exact haversine test removes the false candidates.  Each true
pair meets in exactly one cell, so no dedupe is needed.

Hot cells are split on both sides.  A cell whose requests x businesses exceed
a block's pairs is cut into parts of both: a request goes to one part of its
side and meets every part of the other, so each pair still meets once and no
task gets a hot cell whole.  The list of hot cells is joined without a hint:
Spark broadcasts it while it is small.

``radius_counts`` needs no pairs of rows at all: requests are counted by
coordinate, month and type, distinct coordinates are joined, and the counts are
handed to the businesses of each coordinate last.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.config import CLAMP_LAT, CLAMP_LNG, EARTH_RADIUS_METERS
from tenure.functions.exprs import clamp, haversine_radians

PAIR_COLUMNS = ("unique_key", "month", "complaint_type", "business_id")
_PAIRS_PER_ROW = 256  # a block holds hot_cell_rows x this many pairs


def grid_geometry(radius_meters: float, max_abs_lat: float) -> tuple[float, float, int]:
    """(cell height deg, cell width deg, number of longitude columns)."""
    theta = radius_meters / EARTH_RADIUS_METERS
    height = math.degrees(theta) * 1.0001
    phi = math.radians(min(89.999, max_abs_lat + height))
    ratio = math.sin(theta / 2) / max(math.cos(phi), 1e-12)
    width = 360.0 if ratio >= 1 else math.degrees(2 * math.asin(ratio)) * 1.0001
    n_cols = max(1, int(math.floor(360.0 / width)))
    return height, 360.0 / n_cols, n_cols


def _cell_y(lat: Column, height: float) -> Column:
    return F.floor((lat + F.lit(90.0)) / F.lit(height)).cast("long")


def _cell_x(lng: Column, width: float, n_cols: int) -> Column:
    return F.pmod(F.floor((lng + F.lit(180.0)) / F.lit(width)).cast("long"), F.lit(n_cols).cast("long"))


@dataclass(frozen=True)
class Grid:
    """Cells of a radius; ``None`` bounds mean that there is no business."""

    radius: float
    height: float
    width: float
    columns: int

    @staticmethod
    def over(businesses: DataFrame, radius_meters: float) -> Grid | None:
        # One small aggregate over the businesses fixes the cell width: a request
        # farther than one cell beyond the highest business latitude has no
        # partner, so the business side alone bounds the latitudes that matter.
        bounds = businesses.agg(F.max(F.abs("business_latitude")).alias("m")).first()["m"]
        return None if bounds is None else Grid(radius_meters, *grid_geometry(radius_meters, float(bounds)))

    def own(self, requests: DataFrame) -> DataFrame:
        """Requests in their cell."""
        return requests.withColumn("cy", _cell_y(F.col("latitude"), self.height)).withColumn(
            "cx", _cell_x(F.col("longitude"), self.width, self.columns)
        )

    def around(self, businesses: DataFrame) -> DataFrame:
        """Businesses in their cell and its neighbours."""
        offsets = F.array(*[F.lit(d) for d in (-1, 0, 1)])
        out = (
            businesses.withColumn("dy", F.explode(offsets))
            .withColumn("dx", F.explode(offsets))
            .withColumn("cy", _cell_y(F.col("business_latitude"), self.height) + F.col("dy"))
            .withColumn("cx", F.pmod(_cell_x(F.col("business_longitude"), self.width, self.columns) + F.col("dx"), F.lit(self.columns).cast("long")))
            .drop("dy", "dx")
        )
        # fewer than three longitude columns: neighbours coincide
        return out.dropDuplicates([*businesses.columns, "cy", "cx"]) if self.columns < 3 else out

    def near(self) -> Column:
        theta = self.radius / EARTH_RADIUS_METERS
        spot = [F.col(c) for c in ("latitude", "longitude", "business_latitude", "business_longitude")]
        return haversine_radians(*spot) <= F.lit(theta)


def _located(df: DataFrame, lat: str, lng: str) -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())


def hot_cells(req_cells: DataFrame, biz_cells: DataFrame, block_pairs: int) -> DataFrame:
    """Cells over ``block_pairs`` pairs with the parts that each side is cut
    into: as many blocks as needed, the larger side cut more."""
    a = req_cells.groupBy("cy", "cx").agg(F.count(F.lit(1)).alias("nr"))
    b = biz_cells.groupBy("cy", "cx").agg(F.count(F.lit(1)).alias("nb"))
    blocks = F.ceil(F.col("nr") * F.col("nb") / F.lit(block_pairs))
    cut = F.least(F.col("nr"), F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("nr") / F.col("nb") * F.col("blocks"))))).cast("int")
    return (
        a.join(b, ["cy", "cx"])
        .withColumn("blocks", blocks)
        .where(F.col("blocks") > 1)
        .select("cy", "cx", cut.alias("parts_r"), F.ceil(F.col("blocks") / cut).cast("int").alias("parts_b"))
    )


def _meet(grid: Grid, requests: DataFrame, businesses: DataFrame, req_id: list[str], biz_id: list[str], hot_cell_rows: int | None) -> DataFrame:
    """Rows of both sides within the radius of each other."""
    from tenure.operators.sampling import _checkpoint

    req_cells, biz_cells = grid.own(requests), grid.around(businesses)
    keys = ["cy", "cx"]
    if hot_cell_rows:
        hot = _checkpoint(hot_cells(req_cells, biz_cells, hot_cell_rows * _PAIRS_PER_ROW))
        if not hot.isEmpty():
            part = lambda ids, n: F.pmod(F.xxhash64(*ids), F.coalesce(F.col(n), F.lit(1))).cast("int")
            every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))
            req_cells = req_cells.join(hot, keys, "left").withColumn("pr", part(req_id, "parts_r")).withColumn("pb", every("parts_b"))
            biz_cells = biz_cells.join(hot, keys, "left").withColumn("pb", part(biz_id, "parts_b")).withColumn("pr", every("parts_r"))
            req_cells, biz_cells = (x.drop("parts_r", "parts_b") for x in (req_cells, biz_cells))
            keys = ["cy", "cx", "pr", "pb"]
    return req_cells.join(biz_cells, keys, "inner").where(grid.near())


def radius_join(
    businesses: DataFrame,
    requests: DataFrame,
    radius_meters: float,
    hot_cell_rows: int | None = 200_000,
) -> DataFrame:
    """Request-business pairs within ``radius_meters`` (haversine).

    ``businesses``: business_id, business_latitude, business_longitude.
    ``requests``: unique_key, month, complaint_type, latitude, longitude.
    Returns (unique_key, month, complaint_type, business_id); rows with null
    coordinates on either side never match.
    """
    biz = _located(businesses.select("business_id", "business_latitude", "business_longitude"), "business_latitude", "business_longitude")
    req = _located(requests.select("unique_key", "month", "complaint_type", "latitude", "longitude"), "latitude", "longitude")
    grid = Grid.over(biz, radius_meters)
    if grid is None:
        return _empty_pairs(requests, businesses)
    hot = None if requests.isStreaming else hot_cell_rows
    return _meet(grid, req, biz, ["unique_key"], ["business_id"], hot).select(*PAIR_COLUMNS)


class BusinessSites:
    """The businesses' side of ``radius_counts``, prepared and saved once: a
    stream counts every micro-batch against it."""

    spot, site = ["latitude", "longitude"], ["business_latitude", "business_longitude"]

    def __init__(self, businesses: DataFrame, radius_meters: float, hot_cell_rows: int = 200_000):
        from tenure.operators.sampling import _checkpoint

        self.hot_cell_rows = hot_cell_rows
        biz = _located(businesses.select("business_id", *self.site), *self.site)
        self.grid = Grid.over(biz, radius_meters)
        self.businesses = businesses
        if self.grid is None:
            return
        self.sites = _checkpoint(biz.groupBy(*self.site).agg(F.count(F.lit(1)).alias("tenants")))
        crowded = self.sites.where(F.col("tenants") > F.lit(hot_cell_rows)).withColumn("parts", self._parts()).drop("tenants")
        spread = F.pmod(F.xxhash64("business_id"), F.coalesce(F.col("parts"), F.lit(1))).cast("int")
        self.placed = _checkpoint(biz.join(crowded, self.site, "left").withColumn("part", spread).drop("parts"))

    def _parts(self) -> Column:
        return F.ceil(F.col("tenants") / F.lit(self.hot_cell_rows)).cast("int")

    def counts(self, requests: DataFrame) -> DataFrame:
        """Long form (business_id, month, complaint_type, n)."""
        if self.grid is None:
            return _empty_pairs(requests, self.businesses).select("business_id", "month", "complaint_type", F.lit(0).cast("long").alias("n"))
        counts = self._in_parts(self.site_counts(requests))
        return self.placed.join(counts, [*self.site, "part"]).select("business_id", "month", "complaint_type", "n")

    def _in_parts(self, of_sites: DataFrame) -> DataFrame:
        return of_sites.withColumn("part", F.explode(F.sequence(F.lit(0), self._parts() - 1))).drop("tenants")

    def site_counts(self, requests: DataFrame) -> DataFrame:
        """Counts of the sites themselves: coordinates, tenants, month,
        complaint_type, n.  Not to be called without a business."""
        from tenure.operators.sampling import _checkpoint

        req = _located(requests.select("unique_key", "month", "complaint_type", *self.spot), *self.spot)
        events = _checkpoint(req.groupBy(*self.spot, "month", "complaint_type").agg(F.count("unique_key").alias("n")))
        met = _meet(self.grid, events.select(*self.spot).distinct(), self.sites, self.spot, self.site, self.hot_cell_rows)
        counts = met.select(*self.spot, *self.site, "tenants").join(events, self.spot)
        return counts.groupBy(*self.site, "tenants", "month", "complaint_type").agg(F.sum("n").alias("n"))

    def months(self, site_counts: DataFrame, labels: dict[str, list[str]]) -> DataFrame:
        """One row per business with a request near: (business_id, complaints),
        a map of each month to its total_311 and one number per column of
        ``labels`` (column -> complaint types).  A row is bounded by the number of
        months; the counts are made once a site, not once a business."""
        of = lambda kinds: F.coalesce(F.sum(F.when(F.col("complaint_type").isin(kinds), F.col("n"))), F.lit(0))
        numbers = ["total_311", *labels]
        wide = site_counts.groupBy(*self.site, "tenants", "month").agg(
            F.sum("n").alias("total_311"), *[of(kinds).alias(c) for c, kinds in labels.items()]
        )
        entry = F.struct("month", F.struct(*numbers))
        maps = wide.groupBy(*self.site, "tenants").agg(F.map_from_entries(F.collect_list(entry)).alias("complaints"))
        return self.placed.join(self._in_parts(maps), [*self.site, "part"]).select("business_id", "complaints")


def radius_counts(
    businesses: DataFrame,
    requests: DataFrame,
    radius_meters: float,
    hot_cell_rows: int = 200_000,
) -> DataFrame:
    """Requests within ``radius_meters`` of each business, counted: long form
    (business_id, month, complaint_type, n).  Same rows as counting the pairs
    of ``radius_join``, which are never made.

    Requests become counts by coordinate, month and type, and businesses one site a
    coordinate; only distinct coordinates are joined.  The counts of a site
    go to its businesses last, a site of more than ``hot_cell_rows``
    businesses in parts.
    """
    return BusinessSites(businesses, radius_meters, hot_cell_rows).counts(requests)


def _empty_pairs(requests: DataFrame, businesses: DataFrame) -> DataFrame:
    """Typed empty pair frame (either side empty)."""
    id_type = businesses.schema["business_id"].dataType.simpleString()
    return (
        requests.select("unique_key", "month", "complaint_type")
        .withColumn("business_id", F.lit(None).cast(id_type))
        .where(F.lit(False))
    )


def nearest_centroid(points: DataFrame, lat_col: str, lng_col: str, centroids: list[tuple], prefix: str = "location_cluster") -> DataFrame:
    """Attach the nearest of ``centroids`` [(cluster_id, lat, lng), ...] by
    Euclidean distance in degrees; ties go to the lowest cluster id.  No
    centroids -> id NULL and the point's own coordinates.

    The centroid list is model-sized (k rows), so it is inlined as an array
    literal and the minimum is an array expression: no join at all.
    """
    if not centroids:
        return points.withColumn(prefix, F.lit(None).cast("double")).withColumn(
            f"{prefix}_lat", F.col(lat_col).cast("double")
        ).withColumn(f"{prefix}_lng", F.col(lng_col).cast("double"))
    arr = F.array(
        *[
            F.struct(F.lit(float(cid)).alias("id"), F.lit(float(la)).alias("lat"), F.lit(float(ln)).alias("lng"))
            for cid, la, ln in centroids
        ]
    )
    lat, lng = F.col(lat_col), F.col(lng_col)
    scored = F.transform(
        arr,
        lambda c: F.struct(
            (F.pow(c["lat"] - lat, 2) + F.pow(c["lng"] - lng, 2)).alias("d"),
            c["id"].alias("id"),
            c["lat"].alias("lat"),
            c["lng"].alias("lng"),
        ),
    )
    best = F.array_min(scored)
    return (
        points.withColumn("_best", best)
        .withColumn(prefix, F.col("_best.id"))
        .withColumn(f"{prefix}_lat", F.col("_best.lat"))
        .withColumn(f"{prefix}_lng", F.col("_best.lng"))
        .drop("_best")
    )


def clamp_bounds(df: DataFrame, lat_col: str, lng_col: str) -> DataFrame:
    return df.withColumn(lat_col, clamp(F.col(lat_col), *CLAMP_LAT)).withColumn(lng_col, clamp(F.col(lng_col), *CLAMP_LNG))
