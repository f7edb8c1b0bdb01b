"""Survival datasets derived from the business-month panel.

All operators here group or window on ``business_id``.  The panel holds at
most one row per business-month, so a business's group is bounded by the
number of months in the study window, whatever the data volume: repartition
the panel by ``business_id`` once and the window, the
survival summary and the first-year aggregate share that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, BooleanType

from tenure.config import COX_DROP_COLUMNS
from tenure.functions.exprs import month_diff

ID_COLUMNS = ("business_id", "month", "row_num_within_business")
STATIC_FIRST = ("business_latitude", "business_longitude", "location_cluster_lat", "location_cluster_lng", "location_cluster")
SUM_COLUMNS = ("complaint_sum", "total_311")


def restrict_study_window(panel: DataFrame, study_end) -> DataFrame:
    return panel.where(F.col("month") <= F.lit(study_end).cast("date"))


def survival_summary(panel: DataFrame, survival_months: int) -> DataFrame:
    """Per business: first_month, last_month, duration_months (calendar months
    between them, gaps ignored), survived_36m = duration >= horizon."""
    s = panel.groupBy("business_id").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    duration = month_diff(F.col("last_month"), F.col("first_month")).cast("int")
    return s.select(
        "business_id",
        "first_month",
        "last_month",
        duration.alias("duration_months"),
        (duration >= F.lit(survival_months)).cast("int").alias("survived_36m"),
    )


def eligible_businesses(summary: DataFrame, study_end, survival_months: int, aggregation_months: int) -> DataFrame:
    """first_month <= study_end - horizon and last_month >= first_month + (window - 1)."""
    cutoff = F.add_months(F.lit(study_end).cast("date"), -survival_months)
    return summary.where(
        (F.col("first_month") <= cutoff)
        & (F.col("last_month") >= F.add_months(F.col("first_month"), aggregation_months - 1))
    )


def first_year_window(panel: DataFrame, aggregation_months: int) -> DataFrame:
    """First ``aggregation_months`` observed rows per business (observed rows,
    not calendar months)."""
    w = Window.partitionBy("business_id").orderBy("month")
    return panel.withColumn("row_num_within_business", F.row_number().over(w) - 1).where(
        F.col("row_num_within_business") < aggregation_months
    )


def rule_for(name: str, is_binary: bool | None = None) -> str:
    """Aggregation rule of a feature column (see module docstring of the
    reference behaviour in README): static location -> first; categories ->
    max; complaint types, complaint_sum, total_311 -> sum; licence count ->
    mean; open / months_since_first_license -> max; other 0/1 columns -> max;
    anything else -> last.  Identifier columns are an error."""
    if name in ID_COLUMNS:
        raise ValueError(f"{name} identifies rows and has no aggregation rule")
    if name in STATIC_FIRST:
        return "first"
    if name.startswith("business_category_"):
        return "max"
    if name.startswith("complaint_type_") or name in SUM_COLUMNS:
        return "sum"
    if name == "active_license_count":
        return "mean"
    if name in ("open", "months_since_first_license"):
        return "max"
    if is_binary:
        return "max"
    return "last"


def binary_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, one boolean per column: non-null values all in {0, 1} and at
    least one non-null value."""
    exprs = []
    for c in columns:
        dtype = df.schema[c].dataType
        if isinstance(dtype, (NumericType, BooleanType)):
            v = F.col(c).cast("double")
            ok = F.coalesce(F.bool_and(F.when(v.isNotNull(), v.isin(0.0, 1.0))), F.lit(True))
        else:
            ok = F.lit(False)
        exprs.append((ok & (F.count(F.col(c)) > 0)).alias(c))
    return df.agg(*exprs)


def binary_columns(df: DataFrame, columns: list[str]) -> dict[str, bool]:
    """For each column: non-null values all in {0, 1} and at least one
    non-null.  One aggregate pass over ``df``."""
    if not columns:
        return {}
    exprs = []
    for i, c in enumerate(columns):
        dtype = df.schema[c].dataType
        if isinstance(dtype, (NumericType, BooleanType)):
            v = F.col(c).cast("double")
            exprs.append(F.coalesce(F.bool_and(F.when(v.isNotNull(), v.isin(0.0, 1.0))), F.lit(True)).alias(f"b{i}"))
        else:
            exprs.append(F.lit(False).alias(f"b{i}"))
        exprs.append(F.count(F.col(c)).alias(f"n{i}"))
    row = df.agg(*exprs).first()
    return {c: bool(row[f"b{i}"]) and row[f"n{i}"] > 0 for i, c in enumerate(columns)}


def _agg_expr(name: str, rule: str) -> Column:
    c = F.col(name)
    if rule == "first":
        return F.min_by(c, F.when(c.isNotNull(), F.col("month")))
    if rule == "last":
        return F.max_by(c, F.when(c.isNotNull(), F.col("month")))
    if rule == "sum":
        return F.coalesce(F.sum(c), F.lit(0))
    if rule == "mean":
        return F.avg(c)
    if rule == "max":
        return F.max(c)
    raise ValueError(rule)


def aggregation_plan(window: DataFrame) -> list[tuple[str, str]]:
    """(column, rule) for every feature column of the first-year window, in
    panel order.  Binary detection only runs for columns no name rule covers."""
    features = [c for c in window.columns if c not in ID_COLUMNS]
    undecided = [c for c in features if rule_for(c, None) == "last"]
    binary = binary_columns(window, undecided)
    return [(c, rule_for(c, binary.get(c))) for c in features]


def first_year_aggregate(panel: DataFrame, aggregation_months: int) -> DataFrame:
    """One row per business: ``<col>_first12m_<rule>`` for each feature plus
    ``observed_months_in_first_window``."""
    window = first_year_window(panel, aggregation_months)
    plan = aggregation_plan(window)
    return window.groupBy("business_id").agg(
        *[_agg_expr(c, r).alias(f"{c}_first12m_{r}") for c, r in plan],
        F.count(F.lit(1)).alias("observed_months_in_first_window"),
    )


def training_dataset(panel: DataFrame, study_end, survival_months: int, aggregation_months: int) -> DataFrame:
    """Eligible businesses: first-year features ⋈ (first/last month, duration,
    survived_36m).  ``panel`` should already be restricted to the study window."""
    summary = survival_summary(panel, survival_months)
    eligible = eligible_businesses(summary, study_end, survival_months, aggregation_months)
    eligible_panel = panel.join(eligible.select("business_id"), "business_id", "left_semi")
    features = first_year_aggregate(eligible_panel, aggregation_months)
    return features.join(eligible, "business_id", "inner")


def time_varying_panel(panel: DataFrame, study_end) -> DataFrame:
    """Business-month rows with start = months_since_first - 1, stop =
    months_since_first, event = last observed month and before study end;
    model-excluded columns dropped."""
    p = restrict_study_window(panel, study_end)
    # in the order of the months: the rows of a business come out as they follow each other
    whole = Window.partitionBy("business_id").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.max("month").over(whole)
    end = F.lit(study_end).cast("date")
    out = (
        p.withColumn("start", (F.col("months_since_first_license") - 1).cast("int"))
        .withColumn("stop", F.col("months_since_first_license").cast("int"))
        .withColumn("event", ((F.col("month") == last) & (F.col("month") < end)).cast("int"))
    )
    return out.drop(*[c for c in COX_DROP_COLUMNS if c in out.columns])


def business_level_dataset(panel: DataFrame, study_end) -> DataFrame:
    """One row per business: first non-null value of each feature (month
    order), duration_months and event (last month before study end)."""
    p = restrict_study_window(panel, study_end)
    end = F.lit(study_end).cast("date")
    features = [c for c in p.columns if c not in ("business_id", "month") and c not in COX_DROP_COLUMNS]
    first, last = F.min("month"), F.max("month")
    return p.groupBy("business_id").agg(
        *[_agg_expr(c, "first").alias(c) for c in features],
        month_diff(F.least(last, end), first).cast("int").alias("duration_months"),
        (last < end).cast("int").alias("event"),
    )
