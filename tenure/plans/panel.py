"""Panel build plan: sources -> cleaned -> business-month panel.

``build_panel`` is the flagship job.  The intermediate frames are exposed
(``PanelParts``) so each step can be queried and tested on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import CATEGORY_PREFIX, COMPLAINT_PREFIX, PanelSettings
from tenure.operators import cleaning, clustering, panel, spatial
from tenure.operators.sampling import _checkpoint, _saved, _saved_by


@dataclass
class PanelParts:
    licenses: DataFrame
    requests: DataFrame
    facts: DataFrame
    locations: DataFrame
    centres: list
    clustered: DataFrame
    license_counts: DataFrame
    complaints: DataFrame
    categories: panel.FeatureDictionary
    complaint_types: panel.FeatureDictionary
    panel: DataFrame
    tasks: int


def build_panel_parts(
    licenses_raw: DataFrame,
    requests_raw: DataFrame,
    settings: PanelSettings = PanelSettings(),
    centres: list | None = None,
) -> PanelParts:
    """Full preprocessing flow.  ``centres`` may be given to skip KMeans
    (e.g. a saved model)."""
    licenses = cleaning.clean_licenses(licenses_raw)
    requests = cleaning.clean_service_requests(requests_raw)

    categories = panel.feature_dictionary(licenses, "business_category", CATEGORY_PREFIX)
    license_counts = panel.license_month_counts_by_business(licenses, categories)

    facts = _checkpoint(panel.business_facts(licenses))  # per business; reused by KMeans, merge
    locations = facts.where(F.col("business_latitude").isNotNull()).select(
        "business_id", "business_latitude", "business_longitude"
    )

    def complaint_side():
        return complaint_months(spatial.BusinessSites(locations, settings.radius_meters, settings.hot_cell_rows), requests)

    # KMeans (small iterative jobs) and the radius counts (one large job) only
    # share the business locations: run them side by side
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=2) as pool:
        side = pool.submit(complaint_side)
        if centres is None:
            centres = clustering.fit_location_clusters(
                locations, settings.location_k, settings.kmeans_restarts, settings.kmeans_seed
            )
        complaint_types, complaints = side.result()
    clustered = clustering.assign_location_clusters(
        facts.where(F.col("business_latitude").isNotNull()), centres
    )  # keeps first_license_date: one per-business join in the merge

    merged = panel.merge_panel_by_business(license_counts, complaints, clustered, categories, complaint_types)
    return PanelParts(
        licenses, requests, facts, locations, centres, clustered, license_counts.rows, complaints,
        categories, complaint_types, merged, license_counts.tasks,
    )


def complaint_months(sites: spatial.BusinessSites, requests: DataFrame) -> tuple[panel.FeatureDictionary, DataFrame]:
    """Complaint types near a business and one map of monthly counts per
    business.  The join of coordinates runs once: the sites' counts are saved,
    and both are read from them."""
    if sites.grid is None:
        types = panel.FeatureDictionary(())
        return types, sites.businesses.select("business_id", F.lit(None).cast("map<date,struct<total_311:bigint>>").alias("complaints"))
    counts = _saved(sites.site_counts(requests), "site-counts")
    types = panel.feature_dictionary(counts, "complaint_type", COMPLAINT_PREFIX)
    return types, sites.months(counts, {c: types.labels_for(c) for c in types.columns})


def build_panel(licenses_raw: DataFrame, requests_raw: DataFrame, settings: PanelSettings = PanelSettings()) -> DataFrame:
    return build_panel_parts(licenses_raw, requests_raw, settings).panel


def saved_panel(
    licenses_raw: DataFrame, requests_raw: DataFrame, settings: PanelSettings = PanelSettings(), centres: list | None = None
) -> DataFrame:
    """The panel built and saved by business: what groups or windows by business shuffles none of its rows."""
    parts = build_panel_parts(licenses_raw, requests_raw, settings, centres)
    return _saved_by(parts.panel, "panel", "business_id", parts.tasks)


def write_panel(panel_df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write the panel partitioned by year, rows of a business together and
    month-ordered within each file (no global sort)."""
    out = panel.sort_panel(panel_df).withColumn("year", F.year("month"))
    writer = out.write.mode("overwrite").partitionBy("year")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path
