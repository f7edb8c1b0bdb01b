"""Adapter from the driver's generic test tables to the pipeline's inputs.

The test tables have no licences or service requests, so this module gives
rows in the schema the pipeline expects and nothing more:

* ``orders``  -> licences  (one licence per order, business = customer)
* ``events``  -> service requests
* ``customer`` / ``nation`` -> licence metadata for the map (borough-like facets)
* ``events`` by day -> incremental-ingest landing batches

The same derivation is given as DuckDB SQL (``DUCKDB_*``) so the oracle reads
identical inputs.  Explicit casts keep the doubles equal in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _half(key: F.Column) -> F.Column:
    return F.floor(key.cast("long") / F.lit(2)).cast("long")


def _grid_lat(key: F.Column) -> F.Column:
    return F.lit(40.49).cast("double") + ((_half(key) * 7919) % 4300).cast("double") / F.lit(10000.0)


def _grid_lng(key: F.Column) -> F.Column:
    return F.lit(-74.27).cast("double") + ((_half(key) * 104729) % 5900).cast("double") / F.lit(10000.0)


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence records: license_number, business_id, business_category,
    license_status, issue_date, expire_date, latitude, longitude."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    issue = F.col("o_orderdate").cast("date")
    no_coords = (F.col("o_custkey") % 50) == 7
    return o.select(
        F.col("o_orderkey").cast("string").alias("license_number"),
        F.col("o_custkey").cast("string").alias("business_id"),
        F.col("o_orderpriority").alias("business_category"),
        F.col("o_orderstatus").alias("license_status"),
        issue.alias("issue_date"),
        F.add_months(issue, ((F.col("o_orderkey") * 13) % 31).cast("int")).alias("expire_date"),
        F.when(no_coords, F.lit(None).cast("double")).otherwise(
            _grid_lat(F.col("o_custkey")) + (F.col("o_orderkey") % 5).cast("double") * F.lit(0.00002)
        ).alias("latitude"),
        F.when(no_coords, F.lit(None).cast("double")).otherwise(_grid_lng(F.col("o_custkey"))).alias("longitude"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service requests: unique_key, complaint_type, created_date, latitude, longitude."""
    n_customers = table(spark, sf_dir, "customer").count()
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    anchor = (F.col("event_id") * 31) % F.lit(n_customers)
    return e.select(
        F.col("event_id").cast("string").alias("unique_key"),
        F.col("event_type").alias("complaint_type"),
        F.add_months(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 72).cast("int")).cast("timestamp").alias("created_date"),
        (_grid_lat(anchor) + ((F.col("event_id") % 21) - 10).cast("double") * F.lit(0.00008)).alias("latitude"),
        _grid_lng(anchor).alias("longitude"),
    )


def license_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence metadata for the map: one row per licence with borough-like
    facet (customer market segment mapped onto the five borough names),
    name, industry, address parts and dates."""
    lic = licenses(spark, sf_dir).select(
        F.col("license_number").cast("long").alias("record_ordinal"),
        "license_number", "business_id", "business_category", "license_status", "issue_date", "expire_date", "latitude", "longitude"
    )
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("business_id"),
        F.col("c_name").alias("business_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey"),
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("address_city"))
    borough = (
        F.when(F.col("segment") == "AUTOMOBILE", "Bronx")
        .when(F.col("segment") == "BUILDING", "Brooklyn")
        .when(F.col("segment") == "FURNITURE", "manhattan ")
        .when(F.col("segment") == "HOUSEHOLD", "Queens")
        .when(F.col("segment") == "MACHINERY", "Staten Island")
        .otherwise("Outside")
    )
    return (
        lic.join(cust, "business_id", "left")
        .join(nation, "c_nationkey", "left")
        .select(
            "record_ordinal",
            "business_id",
            "latitude",
            "longitude",
            borough.alias("borough"),
            "business_name",
            F.col("business_category").alias("industry"),
            F.col("license_number").alias("address_building"),
            F.lit("Main St").alias("address_street_name"),
            "address_city",
            F.lit("NY").alias("address_state"),
            F.lit(None).cast("string").alias("address_zip"),
            "license_status",
            F.col("issue_date").alias("license_creation_date"),
            F.col("expire_date").alias("license_expiration_date"),
            "license_number",
            F.col("license_status").alias("license_type"),
            "business_category",
        )
    )


# ---------------------------------------------------------------------------
# DuckDB twins (oracle inputs).  Each is a CTE body.
# ---------------------------------------------------------------------------
_D_LAT = "cast(40.49 as double) + cast((({k}//2)*7919)%4300 as double)/cast(10000 as double)"
_D_LNG = "cast(-74.27 as double) + cast((({k}//2)*104729)%5900 as double)/cast(10000 as double)"

DUCKDB_LICENSES = f"""
select cast(o_orderkey as varchar) license_number, cast(o_custkey as varchar) business_id,
  o_orderpriority business_category, o_orderstatus license_status,
  cast(o_orderdate as date) issue_date,
  cast(cast(o_orderdate as date) + to_months(cast((o_orderkey*13)%31 as int)) as date) expire_date,
  case when o_custkey%50=7 then null else {_D_LAT.format(k='o_custkey')}
    + cast(o_orderkey%5 as double)*cast(0.00002 as double) end latitude,
  case when o_custkey%50=7 then null else {_D_LNG.format(k='o_custkey')} end longitude
from orders
"""

DUCKDB_REQUESTS = f"""
select cast(event_id as varchar) unique_key, event_type complaint_type,
  cast(date '1995-01-01' + to_months(cast(event_id%72 as int)) as timestamp) created_date,
  {_D_LAT.format(k='b')} + cast((event_id%21)-10 as double)*cast(0.00008 as double) latitude,
  {_D_LNG.format(k='b')} longitude
from (select *, (event_id*31)%(select count(*) from customer) b from events) t
"""


def duckdb_with(*ctes: tuple[str, str]) -> str:
    """``WITH`` clause starting with the licence and request adapters."""
    parts = [("lic_raw", DUCKDB_LICENSES), ("req_raw", DUCKDB_REQUESTS), *ctes]
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n"
