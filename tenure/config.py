"""Settings and fixed values.

The constants in the "fixed values" block must equal the reference's for the
results to agree; everything else is a tunable default.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# ---------------------------------------------------------------------------
LOCATION_K = 25
RADIUS_METERS = 50.0
EARTH_RADIUS_METERS = 6_371_000.0
KMEANS_SEED = 42
KMEANS_RESTARTS = 20
SURVIVAL_MONTHS = 36
AGGREGATION_MONTHS = 12
TEST_SIZE = 0.2
RANDOM_STATE = 42
MAX_ITER = 5000
LOGISTIC_C = 1.0
VARIANCE_THRESHOLD = 1e-8
COX_PENALIZER = 0.1
DEFAULT_STUDY_END = dt.date(2026, 3, 1)
NULL_TOKENS = ("", "nan", "None")
CATEGORY_PREFIX = "business_category"
COMPLAINT_PREFIX = "complaint_type"
LICENSE_DATE_FORMAT = "M/d/yyyy"
REQUEST_TS_FORMAT = "M/d/yyyy h:mm:ss a"
REFERENCE_LAT = 40.7128
REFERENCE_LNG = -74.0060
# Clamp box for profile coordinates: lat 40.49..40.92, lng -74.27..-73.68
CLAMP_LAT = (40.49, 40.92)
CLAMP_LNG = (-74.27, -73.68)
# Map bounding box (same box as the clamp box)
MAP_LAT = (40.49, 40.92)
MAP_LNG = (-74.27, -73.68)
MAP_CUTOFF_DATE = dt.date(2026, 3, 1)
COMPLAINT_COUNT_CANDIDATES = ("complaint_sum", "complaint_count", "complaints", "count")
COMPLAINT_TYPE_CANDIDATES = ("complaint_type", "Complaint Type")
# Raw CSV header -> canonical column, licence metadata for the map
LICENSE_METADATA_HEADER_MAP = {
    "Business Unique ID": "business_id",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Borough": "borough",
    "Business Name": "business_name",
    "Industry": "industry",
    "Address Building": "address_building",
    "Address Street Name": "address_street_name",
    "Address City": "address_city",
    "Address State": "address_state",
    "Address Zip": "address_zip",
    "License Status": "license_status",
    "License Creation Date": "license_creation_date",
    "License Expiration Date": "license_expiration_date",
    "Full Address": "full_address",
}
VALID_BOROUGHS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")
COX_SURVIVAL_TIMES = (12, 36, 60, 120)
INSPECT_SURVIVAL_TIMES = (12, 24, 36, 60, 120)
# Columns never used as Cox predictors
COX_DROP_COLUMNS = (
    "open",
    "business_category_sum",
    "complaint_sum",
    "total_311",
    "location_cluster",
    "months_since_first_license",
)
# Columns never used as logistic predictors
LOGISTIC_EXCLUDED = (
    "business_id",
    "first_month",
    "last_month",
    "duration_months",
    "survived_36m",
    "months_since_first_license_first12m_max",
    "business_category_sum_first12m_max",
    "complaint_sum_first12m_sum",
    "total_311_first12m_sum",
    "open_first12m_max",
    "location_cluster_first12m_first",
)
LOCATION_FEATURE_COLUMNS = (
    "business_latitude",
    "business_longitude",
    "location_cluster",
    "location_cluster_lat",
    "location_cluster_lng",
)
REQUIRED_PANEL_COLUMNS = (
    "business_id",
    "month",
    "active_license_count",
    "total_311",
    "open",
    "months_since_first_license",
    "location_cluster",
    "location_cluster_lat",
    "location_cluster_lng",
    "business_latitude",
    "business_longitude",
    "business_category_sum",
    "complaint_sum",
)
# Raw CSV header -> canonical column, licences
LICENSE_HEADER_MAP = {
    "License Number": "license_number",
    "Business Unique ID": "business_id",
    "Business Category": "business_category",
    "License Type": "license_type",
    "License Status": "license_status",
    "Initial Issuance Date": "issue_date",
    "Expiration Date": "expire_date",
    "Latitude": "latitude",
    "Longitude": "longitude",
}
# Raw CSV header -> canonical column, service requests
REQUEST_HEADER_MAP = {
    "Unique Key": "unique_key",
    "Created Date": "created_date",
    "Problem (formerly Complaint Type)": "complaint_type",
    "Latitude": "latitude",
    "Longitude": "longitude",
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PanelSettings:
    """Knobs of the panel build."""

    location_k: int = LOCATION_K
    radius_meters: float = RADIUS_METERS
    kmeans_restarts: int = KMEANS_RESTARTS
    kmeans_seed: int = KMEANS_SEED
    # A grid cell holding more requests than this is split into salted
    # sub-joins so no single task receives a hot cell whole.
    hot_cell_rows: int = 200_000


@dataclass(frozen=True)
class ModelSettings:
    """Knobs shared by the survival models."""

    study_end: dt.date = DEFAULT_STUDY_END
    survival_months: int = SURVIVAL_MONTHS
    aggregation_months: int = AGGREGATION_MONTHS
    variance_threshold: float = VARIANCE_THRESHOLD
    test_size: float = TEST_SIZE
    random_state: int = RANDOM_STATE
    max_iter: int = MAX_ITER
    c: float = LOGISTIC_C
    penalizer: float = COX_PENALIZER
    balance: str = "before_split"  # or "train_only"
    extra: dict = field(default_factory=dict)
