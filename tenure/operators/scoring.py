"""Batch profile scoring.

A *profile request* table has one row per hypothetical business:
``profile_id, active_license_count, business_latitude, business_longitude,
categories array<string>, complaints map<string,double>`` (and optionally a
``month`` for timelines).  ``build_profiles`` turns it into model feature
rows with column expressions only (``array_contains`` / map lookups), so N
requests are scored as N rows with no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.config import CLAMP_LAT, CLAMP_LNG, REFERENCE_LAT, REFERENCE_LNG
from tenure.functions.exprs import clamp
from tenure.operators.quantiles import column_medians
from tenure.operators.spatial import nearest_centroid

# Model-specific names of the numeric profile inputs
LOGISTIC_INPUTS = {
    "license": "active_license_count_first12m_mean",
    "lat": "business_latitude_first12m_first",
    "lng": "business_longitude_first12m_first",
    "cluster": "location_cluster_first12m_first",
    "cluster_lat": "location_cluster_lat_first12m_first",
    "cluster_lng": "location_cluster_lng_first12m_first",
}
COX_INPUTS = {
    "license": "active_license_count",
    "lat": "business_latitude",
    "lng": "business_longitude",
    "cluster": "location_cluster",
    "cluster_lat": "location_cluster_lat",
    "cluster_lng": "location_cluster_lng",
}

# The reference's hypothetical scenarios.
LOGISTIC_SCENARIOS = (
    ("electronics_store", "business_category_electronics_store_first12m_max", 1.0),
    ("vape_shop", "business_category_electronic_cigarette_dealer_first12m_max", 1.0),
    ("bingo_operator", "business_category_bingo_game_operator_first12m_max", 1.0),
    ("many_licenses", "active_license_count_first12m_mean", 5.0),
    ("industrial_laundry", "business_category_industrial_laundry_first12m_max", 1.0),
    ("debt_collection", "business_category_debt_collection_agency_first12m_max", 1.0),
    ("home_improvement_contractor", "business_category_home_improvement_contractor_first12m_max", 1.0),
)
COX_CATEGORY_SCENARIOS = (
    ("electronics_store", "business_category_electronics_store"),
    ("electronic_cigarette_dealer", "business_category_electronic_cigarette_dealer"),
    ("bingo_game_operator", "business_category_bingo_game_operator"),
)


def reference_median(df: DataFrame, lat_col: str, lng_col: str) -> DataFrame:
    """One row (median_lat, median_lng); fallback (40.7128, -74.0060) when
    the column is absent or all-null."""
    have = [c for c in (lat_col, lng_col) if c in df.columns]
    found = column_medians(df, have) if have else df.agg(F.count(F.lit(1)))
    value = lambda c: F.col(f"`{c}`") if c in have else F.lit(None)
    return found.select(
        F.coalesce(value(lat_col), F.lit(REFERENCE_LAT)).cast("double").alias("median_lat"),
        F.coalesce(value(lng_col), F.lit(REFERENCE_LNG)).cast("double").alias("median_lng"),
    )


def distinct_centroids(df: DataFrame, cluster_col: str, lat_col: str, lng_col: str) -> DataFrame:
    """Cluster reference table: (location_cluster, location_cluster_lat,
    location_cluster_lng), nulls dropped, deduplicated (<= k rows)."""
    return (
        df.select(
            F.col(cluster_col).cast("double").alias("location_cluster"),
            F.col(lat_col).cast("double").alias("location_cluster_lat"),
            F.col(lng_col).cast("double").alias("location_cluster_lng"),
        )
        .dropna()
        .dropDuplicates()
    )


def centroid_list(centroids: DataFrame) -> list[tuple]:
    """The centroid table as a list for the array-literal nearest-centroid
    expression: one row per cluster of the fitted model."""
    rows = centroids.orderBy("location_cluster").collect()
    return [(r["location_cluster"], r["location_cluster_lat"], r["location_cluster_lng"]) for r in rows]


def build_profiles(requests: DataFrame, kept_columns: list[str], centroids: list[tuple], names: dict = LOGISTIC_INPUTS) -> DataFrame:
    """Profile requests -> one feature row per request over ``kept_columns``:
    zeros, then licence count / coordinates / nearest centroid, categories
    listed in ``categories`` -> 1, complaint counts from ``complaints``;
    names not among the kept columns are ignored."""
    located = nearest_centroid(requests, "business_latitude", "business_longitude", centroids, prefix="_c")
    numeric = {
        names["license"]: F.col("active_license_count").cast("double"),
        names["lat"]: F.col("business_latitude").cast("double"),
        names["lng"]: F.col("business_longitude").cast("double"),
        names["cluster"]: F.coalesce(F.col("_c").cast("double"), F.lit(0.0)),
        names["cluster_lat"]: F.col("_c_lat").cast("double"),
        names["cluster_lng"]: F.col("_c_lng").cast("double"),
    }
    has_cats = "categories" in requests.columns
    has_cmps = "complaints" in requests.columns
    cols = []
    for c in kept_columns:
        v: Column = F.lit(0.0)
        if c in numeric:
            v = numeric[c]
        else:
            if has_cats:
                v = F.when(F.coalesce(F.array_contains(F.col("categories"), c), F.lit(False)), F.lit(1.0)).otherwise(v)
            if has_cmps:
                v = F.coalesce(F.col("complaints")[c].cast("double"), v)
        cols.append(v.alias(c))
    passthrough = [c for c in ("profile_id", "month") if c in requests.columns]
    return located.select(*passthrough, *cols)


def clamp_profile_coordinates(requests: DataFrame) -> DataFrame:
    return requests.withColumn("business_latitude", clamp(F.col("business_latitude"), *CLAMP_LAT)).withColumn(
        "business_longitude", clamp(F.col("business_longitude"), *CLAMP_LNG)
    )


def baseline_requests(spark_df: DataFrame, lat_col: str, lng_col: str) -> DataFrame:
    """Baseline new-business request: median location of ``spark_df``,
    one licence, no categories or complaints."""
    med = reference_median(spark_df, lat_col, lng_col)
    return med.select(
        F.lit("baseline").alias("profile_id"),
        F.lit(1.0).alias("active_license_count"),
        F.col("median_lat").alias("business_latitude"),
        F.col("median_lng").alias("business_longitude"),
        F.array().cast("array<string>").alias("categories"),
        F.create_map().cast("map<string,double>").alias("complaints"),
    )


def baseline_median_profile(train: DataFrame, kept_columns: list[str]) -> DataFrame:
    """One row 'baseline': exact median of each kept feature."""
    missing = [c for c in kept_columns if c not in train.columns]
    if missing:
        raise ValueError(f"no median can be taken of kept features that the rows lack: {missing}")
    return column_medians(train, kept_columns).select(F.lit("baseline").alias("profile"), *kept_columns)


def _scenario_rows(baseline: DataFrame, scenarios, kept_columns: list[str]) -> DataFrame:
    spec = F.array(
        F.struct(F.lit("baseline").alias("name"), F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("value")),
        *[F.struct(F.lit(n).alias("name"), F.lit(f).alias("feature"), F.lit(float(v)).alias("value")) for n, f, v in scenarios],
    )
    exploded = baseline.withColumn("_s", F.explode(spec))
    return exploded.select(
        F.col("_s.name").alias("profile"),
        F.col("_s.feature").alias("scenario_feature"),
        *[
            F.when(F.col("_s.feature") == F.lit(c), F.col("_s.value")).otherwise(F.col(c).cast("double")).alias(c)
            for c in kept_columns
        ],
    )


def scenario_profiles_logistic(baseline: DataFrame, kept_columns: list[str]) -> DataFrame:
    """Baseline plus the fixed scenarios, each setting one feature if present."""
    return _scenario_rows(baseline, LOGISTIC_SCENARIOS, kept_columns)


def baseline_first_row(panel: DataFrame, kept_columns: list[str]) -> DataFrame:
    """First panel row by (business_id, month) as a template; kept features
    absent from the panel are 0."""
    first = panel.orderBy("business_id", "month").limit(1)
    return first.select(
        F.lit("baseline").alias("profile"),
        *[(F.col(c).cast("double") if c in panel.columns else F.lit(0.0)).alias(c) for c in kept_columns],
    )


def scenario_profiles_cox(baseline: DataFrame, kept_columns: list[str], active_license_override: int = 3) -> DataFrame:
    """Baseline; three category scenarios (other categories zeroed, licence
    count 1); multi-licence business (licence count overridden).  The baseline row is
    found once, not once a scenario and reader."""
    from tenure.operators.sampling import _checkpoint

    baseline = _checkpoint(baseline)
    cats = [c for c in kept_columns if c.startswith("business_category_") and c != "business_category_sum"]
    rows = [baseline.select(F.lit("baseline").alias("profile"), F.lit(None).cast("string").alias("scenario_feature"), *kept_columns)]
    for name, feat in COX_CATEGORY_SCENARIOS:
        cols = []
        for c in kept_columns:
            if c == feat:
                v = F.lit(1.0)
            elif c in cats:
                v = F.lit(0.0)
            elif c == "active_license_count":
                v = F.lit(1.0)
            else:
                v = F.col(c)
            cols.append(v.cast("double").alias(c))
        rows.append(baseline.select(F.lit(name).alias("profile"), F.lit(feat).alias("scenario_feature"), *cols))
    multi = [
        (F.lit(float(active_license_override)) if c == "active_license_count" else F.col(c)).cast("double").alias(c)
        for c in kept_columns
    ]
    rows.append(baseline.select(F.lit("multi_license_business").alias("profile"), F.lit("active_license_count").alias("scenario_feature"), *multi))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def unpivot_nonzero_features(profiles: DataFrame, id_col: str, feature_cols: list[str]) -> DataFrame:
    """(id, feature, value) for every nonzero feature, value descending."""
    long = profiles.unpivot([id_col], feature_cols, "feature", "value")
    return long.where(F.col("value") != 0).orderBy(id_col, F.desc("value"), "feature")


def relation_to_baseline(scored: DataFrame, score_col: str, higher: str = "above_baseline", lower: str = "below_baseline", same: str = "same_as_baseline") -> DataFrame:
    """Label each profile's score against the 'baseline' profile's score."""
    # one value: the first (and only) score of the profile named so
    found = scored.where(F.col("profile") == "baseline").select(F.col(score_col).cast("double")).first()
    base = F.lit(None if found is None else found[0]).cast("double")
    relation = F.when(F.col(score_col) > base, F.lit(higher)).when(F.col(score_col) < base, F.lit(lower)).otherwise(F.lit(same))
    return scored.withColumn("actual_vs_baseline", relation).withColumn("ratio_to_baseline", F.try_divide(F.col(score_col), base))


def directional_check(related: DataFrame, coefs: DataFrame, coef_col: str, up: str, down: str, same: str) -> DataFrame:
    """Expected direction from the scenario feature's coefficient sign vs the
    observed relation; missing feature -> feature_missing / not_checked."""
    c = coefs.select(F.col("feature").alias("scenario_feature"), F.col(coef_col).alias("_coef"))
    j = related.where(F.col("profile") != "baseline").join(c, "scenario_feature", "left")
    expected = (
        F.when(F.col("_coef").isNull(), F.lit("feature_missing"))
        .when(F.col("_coef") > 0, F.lit(up))
        .when(F.col("_coef") < 0, F.lit(down))
        .otherwise(F.lit(same))
    )
    actual = F.when(F.col("_coef").isNull(), F.lit("not_checked")).otherwise(F.col("actual_vs_baseline"))
    return j.select(
        "profile",
        F.col("scenario_feature").alias("feature"),
        expected.alias("expected_vs_baseline"),
        actual.alias("actual_vs_baseline"),
        (F.col("_coef").isNotNull() & (expected == actual)).alias("matches_expectation"),
    )


def check_features_available(kept: DataFrame, required: DataFrame) -> DataFrame:
    """Required features that are not kept (left-anti join); empty = OK."""
    return required.join(kept, "feature", "left_anti")


def flatten_timelines(timepoints: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One display row per timepoint: business, month, licence count,
    coordinates, prettified categories joined by ', ' and complaint counts as
    'Label (n)' sorted by column name; 'None' when empty.  A business stands
    together in month order, without a global sort: the rows are moved and sorted
    before their texts are made.  ``timepoints`` has the profile-request shape plus
    ``business`` and ``month``.

    The labels of the feature ``names`` are made once; a name not among them is
    made readable in its row."""
    from tenure.functions.exprs import prettify_feature_name

    label = prettify_feature_name
    if names:
        frame = timepoints.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "name string")
        known = frame.select("name", prettify_feature_name(F.col("name")).alias("label")).collect()
        labels = F.create_map(*[F.lit(x) for r in known for x in (r["name"], r["label"])])
        label = lambda c: F.coalesce(F.try_element_at(labels, c), prettify_feature_name(c))

    cats = F.array_join(F.transform(F.col("categories"), label), ", ")
    entries = F.array_sort(F.map_entries(F.col("complaints")))
    cmps = F.array_join(
        F.transform(entries, lambda e: F.concat(label(e["key"]), F.lit(" ("), e["value"].cast("int").cast("string"), F.lit(")"))),
        ", ",
    )
    at = F.col("month").cast("int")
    return timepoints.repartition("business").sortWithinPartitions("business", at).select(
        F.col("business").alias("business"),
        at.alias("month"),
        F.col("active_license_count").cast("int").alias("active_license_count"),
        F.col("business_latitude").cast("double").alias("latitude"),
        F.col("business_longitude").cast("double").alias("longitude"),
        F.when(F.size("categories") > 0, cats).otherwise(F.lit("None")).alias("categories"),
        F.when(F.size("complaints") > 0, cmps).otherwise(F.lit("None")).alias("complaint_counts"),
    )


def pivot_risk_over_time(scored: DataFrame, id_col: str, ids: list[str], month_col: str = "month", value_col: str = "partial_hazard", max_columns: int = 1000) -> DataFrame:
    """Month (rows) x chosen profile (columns) risk table for a chart; the
    columns are those asked for, in that order.  More than ``max_columns`` are
    refused: a chart has a line for each, and nothing is left out silently."""
    if len(ids) > max_columns:
        raise ValueError(f"{len(ids)} columns asked for, a chart table has at most {max_columns}")
    rows = scored.where(F.col(id_col).cast("string").isin([str(x) for x in ids]))
    return rows.groupBy(month_col).agg(
        *[F.first(F.when(F.col(id_col).cast("string") == str(x), F.col(value_col)), ignorenulls=True).alias(str(x)) for x in ids]
    ).orderBy(month_col)
