import math
import random

import numpy as np

from tenure.operators import spatial

R = 6_371_000.0


def _hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
    return 2 * math.asin(math.sqrt(min(1.0, x))) * R


def _check(spark, biz, req, radius):
    bdf = spark.createDataFrame(biz, "business_id string, business_latitude double, business_longitude double")
    rdf = spark.createDataFrame(
        [(k, None, "t", la, ln) for k, la, ln in req],
        "unique_key string, month date, complaint_type string, latitude double, longitude double",
    )
    got = sorted((r.unique_key, r.business_id) for r in spatial.radius_join(bdf, rdf, radius, hot_cell_rows=50).collect())
    want = sorted(
        (k, b) for k, la, ln in req for b, bla, bln in biz if _hav(la, ln, bla, bln) <= radius
    )
    assert got == want
    assert len(got) == len(set(got))
    return got


def test_radius_join_matches_brute_force(spark):
    rng = random.Random(7)
    biz = [(f"b{i}", 40.70 + rng.random() * 0.01, -74.0 + rng.random() * 0.01) for i in range(300)]
    req = [(f"r{i}", 40.70 + rng.random() * 0.01, -74.0 + rng.random() * 0.01) for i in range(600)]
    got = _check(spark, biz, req, 50.0)
    assert got  # non-trivial


def test_radius_join_high_latitude_and_hot_cell(spark):
    rng = random.Random(3)
    biz = [(f"b{i}", 78.0 + rng.random() * 0.002, 15.0 + rng.random() * 0.01) for i in range(80)]
    # one hot spot: many requests at nearly the same place (salted path)
    req = [(f"r{i}", 78.001 + rng.random() * 1e-4, 15.005 + rng.random() * 1e-4) for i in range(400)]
    req += [(f"s{i}", 78.0 + rng.random() * 0.002, 15.0 + rng.random() * 0.01) for i in range(100)]
    _check(spark, biz, req, 50.0)


def test_radius_join_empty_side(spark):
    bdf = spark.createDataFrame([], "business_id string, business_latitude double, business_longitude double")
    rdf = spark.createDataFrame([("r", None, "t", 40.0, -74.0)], "unique_key string, month date, complaint_type string, latitude double, longitude double")
    out = spatial.radius_join(bdf, rdf, 50.0)
    assert out.count() == 0 and out.columns == ["unique_key", "month", "complaint_type", "business_id"]


def test_nearest_centroid_and_clamp(spark):
    pts = spark.createDataFrame([(40.705, -74.005), (50.0, -80.0)], "lat double, lng double")
    out = spatial.nearest_centroid(pts, "lat", "lng", [(0, 40.70, -74.00), (1, 40.80, -73.90)]).collect()
    assert (out[0].location_cluster, out[0].location_cluster_lat, out[0].location_cluster_lng) == (0.0, 40.70, -74.00)
    c = spatial.clamp_bounds(pts, "lat", "lng").collect()[1]
    assert (c.lat, c.lng) == (40.92, -74.27)
    empty = spatial.nearest_centroid(pts, "lat", "lng", []).first()
    assert empty.location_cluster is None and empty.location_cluster_lat == 40.705


def test_radius_join_property(spark):
    from hypothesis import given, settings, HealthCheck
    from hypothesis import strategies as st

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(
        lat0=st.floats(-88.0, 88.0),
        lng0=st.sampled_from([-179.9995, -74.0, 0.0, 179.9995]),
        radius=st.sampled_from([5.0, 50.0, 500.0]),
        seed=st.integers(0, 10_000),
    )
    def check(lat0, lng0, radius, seed):
        rng = random.Random(seed)
        span = radius / 111_000.0 * 3
        def pt():
            lng = lng0 + (rng.random() - 0.5) * span / max(math.cos(math.radians(lat0)), 0.05)
            lng = ((lng + 180.0) % 360.0) - 180.0
            return max(-89.9, min(89.9, lat0 + (rng.random() - 0.5) * span)), lng
        biz = [(f"b{i}", *pt()) for i in range(25)]
        req = [(f"r{i}", *pt()) for i in range(40)]
        bdf = spark.createDataFrame(biz, "business_id string, business_latitude double, business_longitude double")
        rdf = spark.createDataFrame([(k, None, "t", a, b) for k, a, b in req],
                                    "unique_key string, month date, complaint_type string, latitude double, longitude double")
        got = {(r.unique_key, r.business_id) for r in spatial.radius_join(bdf, rdf, radius, hot_cell_rows=None).collect()}
        for k, a, b in req:
            for bid, c, d in biz:
                dist = _hav(a, b, c, d)
                if abs(dist - radius) < 1e-6:
                    continue  # last-ulp boundary: either answer is right
                assert ((k, bid) in got) == (dist <= radius), (k, bid, dist, radius)

    check()


def test_kmeans_invariants(spark):
    from tenure.operators import clustering

    rng = random.Random(11)
    centres_true = [(40.6 + 0.05 * i, -74.0 + 0.04 * (i % 3)) for i in range(6)]
    pts = [(f"b{i}", a + rng.gauss(0, 0.004), b + rng.gauss(0, 0.004)) for i in range(300) for a, b in [centres_true[i % 6]]]
    locs = spark.createDataFrame(pts, "business_id string, business_latitude double, business_longitude double")
    best = clustering.fit_location_clusters(locs, 6, restarts=5, seed=42)
    one = clustering.fit_location_clusters(locs, 6, restarts=1, seed=42)
    assigned = clustering.assign_location_clusters(locs, best).collect()
    for r in assigned:  # nearest-centre assignment
        d = [(r.business_latitude - a) ** 2 + (r.business_longitude - b) ** 2 for _, a, b in best]
        assert d[r.location_cluster] == min(d)
    cost_best = clustering.clustering_cost(clustering.assign_location_clusters(locs, best)).first().cost
    cost_one = clustering.clustering_cost(clustering.assign_location_clusters(locs, one)).first().cost
    assert cost_best <= cost_one + 1e-12
    # fewer businesses than clusters: one cluster at the mean
    few = clustering.fit_location_clusters(locs.limit(3), 6)
    assert len(few) == 1 and few[0][0] == 0


def _count_case(spark, biz, req, hot):
    import datetime as dt

    rows = [(k, dt.date(2024, 1 + i % 3, 1), "ab"[i % 2], la, ln) for i, (k, la, ln) in enumerate(req)]
    bdf = spark.createDataFrame(biz, "business_id string, business_latitude double, business_longitude double")
    rdf = spark.createDataFrame(rows, "unique_key string, month date, complaint_type string, latitude double, longitude double")
    want: dict = {}
    for b, bla, bln in biz:
        for _, month, kind, la, ln in rows:
            if None not in (bla, bln, la, ln) and _hav(la, ln, bla, bln) <= 50.0:
                want[b, month, kind] = want.get((b, month, kind), 0) + 1
    got = [tuple(r) for r in spatial.radius_counts(bdf, rdf, 50.0, hot_cell_rows=hot).collect()]
    assert sorted(got) == sorted((*k, n) for k, n in want.items())
    return bdf, rdf


def test_radius_counts_with_a_cell_hot_on_both_sides(spark):
    rng = random.Random(5)
    near = lambda: (40.70 + rng.random() * 2e-4, -74.0 + rng.random() * 2e-4)
    biz = [(f"b{i}", *near()) for i in range(60)] + [(f"s{i}", 40.7001, -73.9999) for i in range(40)] + [("n", None, -74.0)]
    req = [(f"r{i}", *near()) for i in range(150)] + [(f"q{i}", 40.7001, -73.9999) for i in range(200)] + [("z", 40.7, None)]
    bdf, rdf = _count_case(spark, biz, req, 2)  # a block of 512 pairs, a site of 2 businesses
    grid = spatial.Grid.over(bdf, 50.0)
    hot = spatial.hot_cells(grid.own(rdf.dropna()), grid.around(bdf.dropna()), 512).collect()
    assert any(r.parts_r > 1 and r.parts_b > 1 for r in hot)
    _count_case(spark, biz, req, 200_000)


def test_radius_counts_of_nothing(spark):
    bdf, rdf = _count_case(spark, [("b", 40.7, -74.0)], [], 100)
    assert spatial.radius_counts(bdf.limit(0), rdf, 50.0).columns == ["business_id", "month", "complaint_type", "n"]
    _count_case(spark, [("b", 10.0, 10.0)], [("r", 40.0, 40.0)], 100)


def test_kmeans_no_worse_than_separate_fits(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    from tenure.operators import clustering

    rng = np.random.default_rng(2)
    spots = rng.uniform((40.5, -74.2), (40.9, -73.7), (40, 2))
    pts = np.round(spots[rng.integers(0, 40, 3000)] + rng.normal(0, 0.01, (3000, 2)), 4)
    locs = spark.createDataFrame([(f"b{i}", float(a), float(b)) for i, (a, b) in enumerate(pts)], "business_id string, business_latitude double, business_longitude double")
    # a sample smaller than the data: the steps over all points decide
    centres = clustering.fit_location_clusters(locs, 12, restarts=10, sample=500)
    ours = clustering.clustering_cost(clustering.assign_location_clusters(locs, centres)).first().cost
    data = VectorAssembler(inputCols=["business_latitude", "business_longitude"], outputCol="features").transform(locs).select("features").cache()
    theirs = min(KMeans(k=12, seed=42 + i, maxIter=100).fit(data).summary.trainingCost for i in range(10))
    data.unpersist()
    assert len(centres) == 12 and ours <= theirs * (1 + 1e-3)
    assert clustering.fit_location_clusters(locs, 12, restarts=10, sample=500) == centres
    same = spark.createDataFrame([(str(i), 40.0 + i % 3, -74.0) for i in range(30)], locs.schema)
    assert [c[1] for c in clustering.fit_location_clusters(same, 5)] == [40.0, 41.0, 42.0]
    assert clustering.fit_location_clusters(locs.limit(0), 5) == []


def test_kmeans_spreads_points_by_their_number(spark, monkeypatch):
    from tenure.operators import clustering

    rows = [(str(i), 40.5 + (i % 40) * 0.01, -74.0 + (i // 40) * 0.01) for i in range(800)]
    locs = spark.createDataFrame(rows, "business_id string, business_latitude double, business_longitude double").coalesce(1)
    step, tasks = clustering._step, []

    def counted(points, centres, origin):
        tasks.append(points.rdd.getNumPartitions())
        return step(points, centres, origin)

    monkeypatch.setattr(clustering, "_step", counted)
    spread = clustering.fit_location_clusters(locs, 6, restarts=3, task_points=100)
    assert set(tasks) == {8}
    for a, b in zip(spread, clustering.fit_location_clusters(locs, 6, restarts=3)):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 and abs(a[2] - b[2]) < 1e-9
