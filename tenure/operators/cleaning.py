"""Cleaning and validation of licence and service-request records.

Each function is a projection + filter; Catalyst pushes the null filters
down to the scan where the source allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import LICENSE_DATE_FORMAT, REQUEST_TS_FORMAT, REQUIRED_PANEL_COLUMNS
from tenure.functions.exprs import clean_string, month_start, to_date, to_double, to_timestamp

LICENSE_STRING_COLUMNS = ("business_id", "license_number", "business_category", "license_type", "license_status")
LICENSE_REQUIRED = ("business_id", "license_number", "issue_date", "expire_date", "business_category")
REQUEST_REQUIRED = ("unique_key", "created_date", "latitude", "longitude", "complaint_type")


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def clean_licenses(licenses: DataFrame) -> DataFrame:
    """Trim strings, null tokens -> NULL, strict date parse, numeric coords;
    drop rows missing id / number / dates / category; add ``issue_month`` and
    ``expire_month``; keep ``expire_month >= issue_month``."""
    cols = []
    for name in licenses.columns:
        if name in LICENSE_STRING_COLUMNS:
            cols.append(clean_string(F.col(name)).alias(name))
        elif name in ("issue_date", "expire_date"):
            cols.append(to_date(F.col(name), _dtype(licenses, name), LICENSE_DATE_FORMAT).alias(name))
        elif name in ("latitude", "longitude"):
            cols.append(to_double(F.col(name), _dtype(licenses, name)).alias(name))
        else:
            cols.append(F.col(name))
    cleaned = licenses.select(*cols).dropna(subset=list(LICENSE_REQUIRED))
    return (
        cleaned.withColumn("issue_month", month_start(F.col("issue_date")))
        .withColumn("expire_month", month_start(F.col("expire_date")))
        .where(F.col("expire_month") >= F.col("issue_month"))
    )


def clean_service_requests(requests: DataFrame) -> DataFrame:
    """Same pattern for requests; requires key, created timestamp, both
    coordinates and complaint type; adds ``month``."""
    cols = []
    for name in requests.columns:
        if name in ("unique_key", "complaint_type"):
            cols.append(clean_string(F.col(name)).alias(name))
        elif name == "created_date":
            cols.append(to_timestamp(F.col(name), _dtype(requests, name), REQUEST_TS_FORMAT).alias(name))
        elif name in ("latitude", "longitude"):
            cols.append(to_double(F.col(name), _dtype(requests, name)).alias(name))
        else:
            cols.append(F.col(name))
    cleaned = requests.select(*cols).dropna(subset=list(REQUEST_REQUIRED))
    return cleaned.withColumn("month", month_start(F.col("created_date")))


def require_columns(df: DataFrame, required, what: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def panel_violations(panel: DataFrame) -> DataFrame:
    """One row: ``null_months`` and ``duplicate_keys`` (number of
    (business_id, month) keys seen more than once).  One aggregate pass."""
    require_columns(panel, REQUIRED_PANEL_COLUMNS, "Joined dataset")
    per_key = panel.groupBy("business_id", "month").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("month").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_months"),
        F.count_if(F.col("n") > 1).cast("long").alias("duplicate_keys"),
    )


def validate_panel(panel: DataFrame) -> None:
    """Raise ``ValueError`` on missing columns, null months or duplicate keys."""
    row = panel_violations(panel).first()
    if row["null_months"]:
        raise ValueError(f"panel has {row['null_months']} rows with a null month")
    if row["duplicate_keys"]:
        raise ValueError(f"panel has {row['duplicate_keys']} (business_id, month) keys with several rows")


def restrict_study_window(panel: DataFrame, study_end) -> DataFrame:
    return panel.where(F.col("month") <= F.lit(study_end).cast("date"))


def drop_columns(df: DataFrame, columns) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])
