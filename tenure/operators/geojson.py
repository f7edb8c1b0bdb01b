"""Map export: business activity summary ⋈ licence metadata -> GeoJSON
features, plus the map's facet helpers (complaint bins, licence bands,
borough, OR-within / AND-across facet filter).

Every per-business value is an aggregate with map-side partial aggregation
(``max``, ``sum``, ``count``, ``min_by`` over the file ordinal), so a business
with a huge number of licences never lands whole in one task.  Licence
records (with the file ordinal) are nested in chunks of bounded size: a Feature
carries its records if they make one chunk and the number of its chunks
otherwise, and the chunks are written beside the Features, all newline-delimited
(gzip) by the executors.  The export (``export_map``) shuffles the records once and
writes everything from what it saved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import (
    COMPLAINT_COUNT_CANDIDATES,
    COMPLAINT_TYPE_CANDIDATES,
    MAP_LAT,
    MAP_LNG,
    VALID_BOROUGHS,
)
from tenure.functions.exprs import to_date, to_double

ADDRESS_PARTS = ("address_building", "address_street_name", "address_city", "address_state", "address_zip")
RECORD_FIELDS = (
    "business_id", "latitude", "longitude", "borough", "business_name", "industry", "address_building",
    "address_street_name", "address_city", "address_state", "address_zip", "license_status",
    "license_creation_date", "license_expiration_date", "full_address", "license_number", "license_type",
    "business_category",
)


def validate_panel_map(panel: DataFrame) -> str:
    """Needs business_id, month and a complaint signal; returns the column
    the complaint signal comes from (or 'none')."""
    missing = [c for c in ("business_id", "month") if c not in panel.columns]
    if missing:
        raise ValueError(f"Joined dataset is missing required columns: {missing}")
    for c in (*COMPLAINT_COUNT_CANDIDATES, *COMPLAINT_TYPE_CANDIDATES):
        if c in panel.columns:
            return c
    raise ValueError("Joined dataset has no complaint count or complaint type column.")


def validate_license_metadata(meta: DataFrame) -> None:
    missing = [c for c in ("business_id", "latitude", "longitude", "borough") if c not in meta.columns]
    if missing:
        raise ValueError(f"Licence dataset is missing required columns: {missing}")


def clean_business_ids(panel: DataFrame) -> DataFrame:
    """Trim ids; drop null and empty ids."""
    return panel.withColumn("business_id", F.trim(F.col("business_id").cast("string"))).where(
        F.col("business_id").isNotNull() & (F.col("business_id") != "")
    )


def clean_license_fields(meta: DataFrame) -> DataFrame:
    """Trim id, trim + title-case borough, numeric coordinates, dates."""
    out = meta.withColumn("business_id", F.trim(F.col("business_id").cast("string")))
    if "borough" in out.columns:
        out = out.withColumn("borough", F.initcap(F.trim(F.col("borough"))))
    for c in ("latitude", "longitude"):
        out = out.withColumn(c, to_double(F.col(c), out.schema[c].dataType))
    for c in ("license_creation_date", "license_expiration_date"):
        if c in out.columns:
            out = out.withColumn(c, to_date(F.col(c), out.schema[c].dataType, "M/d/yyyy"))
    return out


def build_full_address(meta: DataFrame) -> DataFrame:
    """Space-join of the non-blank address parts present; '' if none."""
    parts = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ADDRESS_PARTS if c in meta.columns]
    if not parts:
        return meta.withColumn("full_address", F.lit(""))
    return meta.withColumn("full_address", F.array_join(F.filter(F.array(*parts), lambda x: x != ""), " "))


def filter_boroughs(meta: DataFrame) -> DataFrame:
    return meta.where(F.col("borough").isin(*VALID_BOROUGHS))


def filter_bbox(meta: DataFrame, lat=MAP_LAT, lng=MAP_LNG) -> DataFrame:
    """Inclusive box; NULL coordinates fail."""
    return meta.where(F.col("latitude").between(*lat) & F.col("longitude").between(*lng))


def prepare_geojson_inputs(panel: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    validate_panel_map(panel)
    validate_license_metadata(meta)
    licenses = filter_bbox(filter_boroughs(build_full_address(clean_license_fields(meta))))
    return clean_business_ids(panel), licenses


def complaint_signal(panel: DataFrame):
    """First available count column (non-numeric / NULL -> 0), else a
    not-null flag of a complaint-type column, else 0."""
    for c in COMPLAINT_COUNT_CANDIDATES:
        if c in panel.columns:
            return F.coalesce(to_double(F.col(c), panel.schema[c].dataType), F.lit(0.0))
    for c in COMPLAINT_TYPE_CANDIDATES:
        if c in panel.columns:
            return F.col(c).isNotNull().cast("double")
    return F.lit(0.0)


def business_activity_summary(panel: DataFrame, cutoff_date) -> DataFrame:
    """Per business: last month, complaint sum, active = last_month >= cutoff."""
    s = panel.groupBy("business_id").agg(
        F.max("month").alias("last_month"), F.sum(complaint_signal(panel)).alias("complaint_sum")
    )
    return s.withColumn("active", (F.col("last_month") >= F.lit(cutoff_date).cast("date")).cast("int"))


def business_license_metadata(meta: DataFrame) -> DataFrame:
    """Per business: first record's coordinates and borough (file order),
    licence count."""
    o = F.col("record_ordinal")
    return meta.groupBy("business_id").agg(
        F.min_by("latitude", o).alias("latitude"),
        F.min_by("longitude", o).alias("longitude"),
        F.min_by("borough", o).alias("first_borough"),
        F.count(F.lit(1)).alias("license_count"),
    )


def license_record_rows(meta: DataFrame) -> DataFrame:
    """One row per licence record: business_id, record_ordinal, record
    (struct of the present fields, dates as yyyy-MM-dd)."""
    fields = []
    for c in RECORD_FIELDS:
        if c not in meta.columns:
            continue
        v = F.col(c)
        if c.endswith("_date"):
            v = F.date_format(v, "yyyy-MM-dd")
        fields.append(v.alias(c))
    return meta.select("business_id", "record_ordinal", F.struct(*fields).alias("record"))


def license_record_chunks(meta: DataFrame, per_chunk: int = 1000) -> DataFrame:
    """(business_id, chunk, chunks, license_records): the records of a business
    in file order, those of a business of more than ``per_chunk`` spread over
    chunks by a hash of their ordinal, so none is gathered whole."""
    rows = license_record_rows(meta)
    large = rows.groupBy("business_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per_chunk)
    large = large.select("business_id", F.ceil(F.col("n") / F.lit(per_chunk)).cast("int").alias("chunks"))
    chunks = F.coalesce(F.col("chunks"), F.lit(1))
    placed = rows.join(large, "business_id", "left").withColumn("chunk", F.pmod(F.xxhash64("record_ordinal"), chunks).cast("int"))
    nested = placed.groupBy("business_id", "chunk").agg(
        F.max(chunks).alias("chunks"), F.sort_array(F.collect_list(F.struct("record_ordinal", "record"))).alias("own")
    )
    return nested.select("business_id", "chunk", "chunks", F.transform("own", lambda x: x["record"]).alias("license_records"))


@dataclass(frozen=True)
class SavedRecords:
    """Licence records by business, shuffled once and saved as Parquet: ``whole`` has those of a
    business of up to ``per_chunk`` in one row (business_id, own), in files by hash of the
    business; ``cut`` those of the others in chunks (business_id, chunk, chunks, own).  ``own`` are the
    (record_ordinal, record) in file order."""

    whole: DataFrame
    cut: DataFrame
    tasks: int

    @staticmethod
    def of(meta: DataFrame, per_chunk: int = 1000, task_rows: int = 100_000) -> SavedRecords:
        from tenure.operators.sampling import _checkpoint, _saved, _saved_by

        rows = license_record_rows(meta)
        sizes = rows.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"))
        shape = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
        tasks = max(1, -(-(shape["n"] or 0) // task_rows))
        own = F.sort_array(F.collect_list(F.struct("record_ordinal", "record"))).alias("own")
        large = sizes.where(F.col("n") > per_chunk).select("business_id", F.ceil(F.col("n") / F.lit(per_chunk)).cast("int").alias("chunks"))
        few = rows
        if (shape["most"] or 0) > per_chunk:
            large = _checkpoint(large)
            few = rows.join(large, "business_id", "left_anti")
        place = F.pmod(F.xxhash64("record_ordinal"), F.col("chunks")).cast("int")
        many = rows.join(large, "business_id").withColumn("chunk", place).groupBy("business_id", "chunk", "chunks").agg(own)
        whole = few.repartition(tasks, "business_id").groupBy("business_id").agg(own)
        cut = many.where(F.lit(False)) if few is rows else _saved(many, "record-chunks")
        return SavedRecords(_saved_by(whole, "map-records", "business_id", tasks), cut, tasks)

    def chunks(self) -> DataFrame:
        """The records of the businesses that have several chunks, as ``license_record_chunks`` gives them."""
        return self.cut.select("business_id", "chunk", "chunks", F.transform("own", lambda x: x["record"]).alias("license_records"))

    def rows(self) -> DataFrame:
        """One row per licence record, as ``license_record_rows`` gives them."""
        one = lambda df: df.select("business_id", F.explode("own").alias("x")).select("business_id", "x.record_ordinal", "x.record")
        return one(self.whole).unionByName(one(self.cut))

    def attach(self, businesses: DataFrame) -> DataFrame:
        """``with_license_records``: the records stay in their files' tasks, only businesses move."""
        records = F.transform("own", lambda x: x["record"])
        whole = self.whole.select("business_id", records.alias("license_records"))
        several = self.cut.groupBy("business_id").agg(F.max("chunks").alias("_chunks"))
        out = businesses.join(whole, "business_id", "left").join(several, "business_id", "left")
        count = F.when(F.col("license_records").isNotNull(), F.lit(1)).otherwise(F.col("_chunks")).cast("int")
        return out.select(*businesses.columns, count.alias("license_record_chunks"), "license_records")


def export_map(businesses: DataFrame, meta: DataFrame, root: str) -> tuple[DataFrame, dict[str, str]]:
    """The Features with their records, and the paths of what was written below ``root``: Features, records
    of the exported businesses, chunks.  Records are shuffled once and businesses made once."""
    from tenure.operators.sampling import _saved_by

    records = SavedRecords.of(meta)
    kept = _saved_by(businesses.repartition(records.tasks, "business_id"), "map-businesses", "business_id", records.tasks)
    features = geo_feature(records.attach(kept))
    return features, {
        "geojson": write_geojson(features, f"{root}/geojson"),
        "license_records": _write_record_rows(features, records.rows(), f"{root}/license_records"),
        "record_chunks": write_record_chunks(features, records.chunks(), f"{root}/license_record_chunks"),
    }


def with_license_records(businesses: DataFrame, chunks: DataFrame) -> DataFrame:
    """Businesses with ``license_records`` (where they are one chunk) and
    ``license_record_chunks``."""
    one = chunks.groupBy("business_id").agg(
        F.max("chunks").alias("license_record_chunks"), F.first(F.when(F.col("chunks") == 1, F.col("license_records")), ignorenulls=True).alias("license_records")
    )
    return businesses.join(one, "business_id", "left")


def write_record_chunks(features: DataFrame, chunks: DataFrame, path: str) -> str:
    """The chunks of the exported businesses that have several, one
    {"business_id", "chunk", "license_records"} per line."""
    rows = chunks.where("chunks > 1").join(features.select("business_id"), "business_id", "left_semi")
    value = F.to_json(F.struct("business_id", "chunk", "license_records"), {"ignoreNullFields": "false"})
    return _write_lines(rows.select(value.alias("value")), path)


def join_geo(summary: DataFrame, metadata: DataFrame) -> DataFrame:
    return summary.join(metadata, "business_id", "inner")


def geo_feature(businesses: DataFrame) -> DataFrame:
    """business_id + ``feature`` struct (Point + properties); rows without
    coordinates dropped."""
    props = [
        F.col("business_id"),
        F.coalesce(F.col("active"), F.lit(0)).cast("int").alias("active"),
        F.date_format("last_month", "yyyy-MM-dd").alias("last_month"),
        F.coalesce(F.col("complaint_sum"), F.lit(0.0)).cast("double").alias("complaint_sum"),
        F.coalesce(F.col("license_count"), F.lit(0)).cast("int").alias("license_count"),
        F.col("first_borough").alias("borough"),
    ]
    props += [F.col(c) for c in ("license_record_chunks", "license_records") if c in businesses.columns]
    return businesses.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "business_id",
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("Point").alias("type"), F.array(F.col("longitude").cast("double"), F.col("latitude").cast("double")).alias("coordinates")).alias("geometry"),
            F.struct(*props).alias("properties"),
        ).alias("feature"),
    )


def write_geojson(features: DataFrame, path: str) -> str:
    """Newline-delimited GeoJSON: one Feature per line, written by executors."""
    return _write_lines(features.select(F.to_json("feature", {"ignoreNullFields": "false"}).alias("value")), path)


def write_license_records(features: DataFrame, meta: DataFrame, path: str) -> str:
    """All licence records of the exported businesses, newline-delimited: one
    {"business_id", "record_ordinal", "record"} per line."""
    return _write_record_rows(features, license_record_rows(meta), path)


def _write_record_rows(features: DataFrame, rows: DataFrame, path: str) -> str:
    rows = rows.join(features.select("business_id"), "business_id", "left_semi")
    value = F.to_json(F.struct("business_id", "record_ordinal", "record"), {"ignoreNullFields": "false"})
    return _write_lines(rows.select(value.alias("value")), path)


def _write_lines(lines: DataFrame, path: str) -> str:
    """Lines as gzip text files (names and values repeat in every record)."""
    lines.write.mode("overwrite").option("compression", "gzip").text(path)
    return path


def write_feature_collection(features: DataFrame, path: str, max_features: int = 100_000) -> str:
    """Opt-in single-document export ({"type": "FeatureCollection", ...}) for
    small maps.  One document means one task, so the feature count is
    checked first; larger exports use ``write_geojson`` (one Feature per line)."""
    n = features.count()
    if n > max_features:
        raise ValueError(f"{n} features exceed the single-document limit {max_features}; use write_geojson")
    doc = features.select(F.to_json("feature", {"ignoreNullFields": "false"}).alias("f")).agg(
        F.concat(
            F.lit('{"type":"FeatureCollection","features":['),
            F.coalesce(F.array_join(F.array_sort(F.collect_list("f")), ","), F.lit("")),
            F.lit("]}"),
        ).alias("value")
    )
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


# ------------------------------------------------------- facet helpers ----
def complaint_bin(col) -> F.Column:
    return (
        F.when(col.isNull() | F.isnan(col.cast("double")), F.lit("Unknown"))
        .when(col == 0, F.lit("0"))
        .when(col <= 2, F.lit("1-2"))
        .when(col <= 5, F.lit("3-5"))
        .when(col <= 10, F.lit("6-10"))
        .when(col <= 20, F.lit("11-20"))
        .when(col <= 50, F.lit("21-50"))
        .when(col <= 100, F.lit("51-100"))
        .otherwise(F.lit("101+"))
    )


def license_band(col) -> F.Column:
    return F.when(col.isNull(), F.lit("Unknown")).when(col <= 1, F.lit("Single license")).otherwise(F.lit("Multiple licenses"))


def active_label(col) -> F.Column:
    return F.when(col == 1, F.lit("Active")).otherwise(F.lit("Inactive"))


def display_borough(col) -> F.Column:
    t = F.trim(col)
    return F.when(col.isNull() | (t == ""), F.lit("Unknown")).otherwise(t)


def facet_table(features: DataFrame) -> DataFrame:
    """Facet values of each feature: borough, status, complaint bin, licence band."""
    p = F.col("feature.properties")
    return features.select(
        "business_id",
        display_borough(p["borough"]).alias("borough"),
        active_label(p["active"]).alias("status"),
        complaint_bin(p["complaint_sum"]).alias("complaint_bin"),
        license_band(p["license_count"]).alias("license_band"),
    )


def facet_values(facets: DataFrame, facet: str) -> DataFrame:
    """Distinct values of one facet with their counts, sorted."""
    return facets.groupBy(facet).agg(F.count(F.lit(1)).alias("n")).orderBy(facet)


def facet_filter(facets: DataFrame, selected: dict[str, list[str]]) -> DataFrame:
    """OR within a facet, AND across facets; an empty selection is no filter."""
    cond = F.lit(True)
    for facet, values in selected.items():
        if values:
            cond = cond & F.col(facet).isin(*values)
    return facets.where(cond)
