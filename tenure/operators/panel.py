"""Business-month panel: interval expansion, category/complaint counts,
business locations and the final merge.

Shuffle plan (see README "Panel plan"):

* licences are shuffled by ``business_id`` as they are, in as
  many tasks as their number needs; there the months in which a business's counts change are
  summed up, and the months between are filled in last, after the join, so no licence is expanded; a business with a
  huge number of licences never lands whole in one task: its months are aggregated by
  ``(business_id, month, licence)`` with map-side partial aggregation;
* per-business facts (first licence date, median location) come from one
  ``groupBy(business_id)`` over the cleaned licences;
* the complaint counts come as one map of months a business, so the
  licence ⟕ complaint join runs on ``business_id`` and the panel's rows, made
  after the shuffle, are never moved;
* the panel is bounded per business by the number of months, so the final
  per-business join holds at most one row per business-month.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenure.config import CATEGORY_PREFIX, COMPLAINT_PREFIX, LOCATION_FEATURE_COLUMNS
from tenure.functions.exprs import month_diff, sanitize_feature_name
from tenure.operators.quantiles import grouped_medians


@dataclass(frozen=True)
class FeatureDictionary:
    """Raw label -> generated column name (several labels may share a column)."""

    raw_to_column: tuple[tuple[str, str], ...]

    @property
    def columns(self) -> list[str]:
        return sorted({c for _, c in self.raw_to_column})

    def labels_for(self, column: str) -> list[str]:
        return [raw for raw, c in self.raw_to_column if c == column]


def month_range(spark, start, end) -> DataFrame:
    """Inclusive month starts between two dates, one row each (column ``month``)."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.trunc(F.lit(start).cast("date"), "month"),
                F.trunc(F.lit(end).cast("date"), "month"),
                F.expr("INTERVAL 1 MONTH"),
            )
        ).alias("month")
    )


def expand_to_months(licenses: DataFrame) -> DataFrame:
    """One row per licence per active month (issue..expire, inclusive).
    Narrow: no shuffle, duplicates kept."""
    return licenses.withColumn(
        "month",
        F.explode(F.sequence(F.col("issue_month"), F.col("expire_month"), F.expr("INTERVAL 1 MONTH"))),
    )


# Generated names that would collide with the panel's own columns.
RESERVED_NAMES = (f"{CATEGORY_PREFIX}_sum",)


def feature_dictionary_frame(df: DataFrame, label_col: str, prefix: str) -> DataFrame:
    """Distinct labels -> sanitized name -> ``name``, ``name_1``, ``name_2`` in
    sorted-label order.  A name reserved by the panel (the category row sum)
    starts at ``_1``.  Bounded by the number of distinct labels."""
    labels = df.select(F.col(label_col).alias("raw")).where(F.col("raw").isNotNull()).distinct()
    named = labels.withColumn("base", sanitize_feature_name(F.col("raw"), prefix))
    rank = F.row_number().over(Window.partitionBy("base").orderBy("raw")) - 1
    rank = rank + F.col("base").isin(*RESERVED_NAMES).cast("int")
    return named.withColumn("k", rank).select(
        "raw",
        F.when(F.col("k") == 0, F.col("base")).otherwise(F.concat_ws("_", F.col("base"), F.col("k").cast("string"))).alias("feature"),
    )


def feature_dictionary(df: DataFrame, label_col: str, prefix: str) -> FeatureDictionary:
    rows = feature_dictionary_frame(df, label_col, prefix).collect()
    return FeatureDictionary(tuple(sorted((r["raw"], r["feature"]) for r in rows)))


def _wide_counts(label_col: str, dictionary: FeatureDictionary) -> list:
    """``count(label in labels_of(column))`` per generated column: a pivot with
    an explicit value list, evaluated inside the same aggregate."""
    return [
        F.count(F.when(F.col(label_col).isin(dictionary.labels_for(c)), F.lit(1))).alias(c)
        for c in dictionary.columns
    ]


def license_month_counts(expanded: DataFrame, dictionary: FeatureDictionary) -> DataFrame:
    """Per (business, month): distinct active licence numbers and non-distinct
    licence rows per category, 0-filled.

    One aggregate by (business, month, licence) counts the categories, one over
    its rows adds them up and counts the licences: the expanded rows are
    made and shuffled once, and nothing is joined."""
    each = expanded.groupBy("business_id", "month", "license_number").agg(
        F.count(F.lit(1)).alias("_rows"), *_wide_counts("business_category", dictionary)
    )
    return each.groupBy("business_id", "month").agg(
        F.count("license_number").alias("active_license_count"), *[F.sum(c).alias(c) for c in dictionary.columns]
    )


@dataclass(frozen=True)
class MonthCounts:
    """Licence counts by business and run of months with the same counts (``_from`` to ``_to``),
    and the number of tasks that their businesses are spread over."""

    runs: DataFrame
    tasks: int

    @property
    def rows(self) -> DataFrame:
        """Licence counts by (business, month)."""
        return _months_of_runs(self.runs)


def license_month_counts_by_business(
    licenses: DataFrame, dictionary: FeatureDictionary, hot_rows: int = 100_000, task_rows: int = 100_000
) -> MonthCounts:
    """``license_month_counts`` of the expanded licences, which are shuffled as
    they are (one row a licence) and never expanded: only the months in which a
    business's counts change are made, and the months between them last.

    In the order of the issue months, a licence number is new in those months of a
    row that come after all earlier rows' last month, so that the changes count
    distinct licences.  Businesses of more than ``hot_rows`` rows are expanded
    and aggregated with map-side partial aggregation."""
    from tenure.operators.sampling import _checkpoint

    slim = licenses.select("business_id", "license_number", "business_category", "issue_month", "expire_month")
    sizes = slim.groupBy("business_id").agg(F.count(F.lit(1)).alias("_rows"))
    total = sizes.agg(F.sum("_rows").alias("n"), F.max("_rows").alias("most")).first()
    tasks = max(1, -(-(total["n"] or 0) // task_rows))
    few, many = slim, None
    if (total["most"] or 0) > hot_rows:
        hot = _checkpoint(sizes.where(F.col("_rows") > hot_rows).select("business_id"))
        few = slim.join(hot, "business_id", "left_anti")
        many = license_month_counts(expand_to_months(slim.join(hot, "business_id", "left_semi")), dictionary)
    runs = _runs_of_changes(_month_changes(few.repartition(tasks, "business_id"), dictionary), dictionary)
    if many is not None:
        runs = runs.unionByName(many.withColumn("_to", F.col("month")).withColumnRenamed("month", "_from"))
    return MonthCounts(runs, tasks)


def _month_changes(licenses: DataFrame, dictionary: FeatureDictionary) -> DataFrame:
    """Per (business, month of a change): how the numbers of licence rows
    (``_rows``), distinct licences and rows by category change against the month
    before.  At most three changes a licence: its first month, its first new
    month if that comes later, and the month after its last."""
    earlier = Window.partitionBy("business_id", "license_number").orderBy("issue_month").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("issue_month"), F.add_months(F.max("expire_month").over(earlier), 1))  # greatest skips nulls
    after = F.add_months(F.col("expire_month"), 1)
    spans = licenses.withColumn("_fresh", F.when(F.col("license_number").isNotNull(), fresh)).withColumn("_after", after)
    spans = spans.withColumn("_new", F.coalesce(F.col("_fresh") < F.col("_after"), F.lit(False)))

    def change(month, rows, licences):
        return F.struct(month.alias("month"), F.lit(rows).alias("rows"), licences.cast("int").alias("licences"))

    at_once = F.col("_new") & (F.col("_fresh") == F.col("issue_month"))
    changes = F.array(
        change(F.col("issue_month"), 1, at_once),
        change(F.col("_after"), -1, -F.col("_new").cast("int")),
        F.when(F.col("_new") & ~at_once, change(F.col("_fresh"), 0, F.lit(1))),
    )
    steps = spans.select("business_id", "business_category", F.explode(changes).alias("c")).where(F.col("c").isNotNull())
    of = lambda labels: F.sum(F.when(F.col("business_category").isin(labels), F.col("c.rows")).otherwise(0))
    return steps.groupBy("business_id", F.col("c.month").alias("month")).agg(
        F.sum("c.rows").alias("_rows"),
        F.sum("c.licences").alias("active_license_count"),
        *[of(dictionary.labels_for(c)).alias(c) for c in dictionary.columns],
    )


def _runs_of_changes(changes: DataFrame, dictionary: FeatureDictionary) -> DataFrame:
    """Runs of months with a licence and the same counts, from the running sums of the changes."""
    order = Window.partitionBy("business_id").orderBy("month")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    counts = ["active_license_count", *dictionary.columns]
    run = changes.select(
        "business_id",
        F.col("month").alias("_from"),
        F.add_months(F.lead("month").over(order), -1).alias("_to"),
        *[F.sum(c).over(upto).alias(c) for c in ("_rows", *counts)],
    )
    return run.where(F.col("_rows") > 0).drop("_rows")


def _months_of_runs(runs: DataFrame) -> DataFrame:
    months = F.explode(F.sequence("_from", "_to", F.expr("INTERVAL 1 MONTH"))).alias("month")
    return runs.select("business_id", months, *[c for c in runs.columns if c not in ("business_id", "_from", "_to")])


def business_facts(licenses: DataFrame, hot_rows: int = 100_000) -> DataFrame:
    """Per business: first licence date and median lat / lng over licences that
    have both coordinates (exact, interpolated medians).

    A business of more than ``hot_rows`` licences is not gathered: its
    medians come from rank selection over range partitions
    (``quantiles.grouped_medians``).  Both ways give the same value."""
    from tenure.operators.sampling import _checkpoint

    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    sizes = licenses.groupBy("business_id").agg(F.count(F.lit(1)).alias("_rows"), F.min("issue_date").alias("first_license_date"))
    hot = _checkpoint(sizes.where(F.col("_rows") > hot_rows).drop("_rows"))
    few = licenses if hot.isEmpty() else licenses.join(hot.select("business_id"), "business_id", "left_anti")
    facts = few.groupBy("business_id").agg(
        F.min("issue_date").alias("first_license_date"),
        F.median(F.when(located, F.col("latitude"))).alias("business_latitude"),
        F.median(F.when(located, F.col("longitude"))).alias("business_longitude"),
    )
    if few is licenses:
        return facts
    spots = licenses.where(located).join(hot.select("business_id"), "business_id", "left_semi")
    axes = F.array(*[F.struct(F.lit(i).alias("axis"), F.col(c).cast("double").alias("value")) for i, c in enumerate(("latitude", "longitude"))])
    long = spots.select("business_id", F.explode(axes).alias("x")).select("business_id", "x.axis", "x.value")
    axis = lambda i: F.max(F.when(F.col("axis") == i, F.col("median")))
    middle = grouped_medians(long, ["business_id", "axis"]).groupBy("business_id").agg(
        axis(0).alias("business_latitude"), axis(1).alias("business_longitude")
    )
    return facts.unionByName(hot.join(middle, "business_id", "left").select(*facts.columns))


def business_locations(licenses: DataFrame) -> DataFrame:
    """One row per located business: business_id, business_latitude, business_longitude."""
    return (
        business_facts(licenses)
        .where(F.col("business_latitude").isNotNull())
        .select("business_id", "business_latitude", "business_longitude")
    )


def license_panel(licenses: DataFrame, dictionary: FeatureDictionary | None = None) -> tuple[DataFrame, FeatureDictionary]:
    """Licence panel: counts + categories + months_since_first_license + open."""
    if dictionary is None:
        dictionary = feature_dictionary(licenses, "business_category", CATEGORY_PREFIX)
    counts = license_month_counts(expand_to_months(licenses), dictionary)
    first = licenses.groupBy("business_id").agg(F.min("issue_date").alias("first_license_date"))
    panel = counts.join(first, "business_id", "left").select(
        *counts.columns,
        month_diff(F.col("month"), F.col("first_license_date")).alias("months_since_first_license"),
        F.lit(1).alias("open"),
    )
    return panel, dictionary


def complaint_panel_from_long(long: DataFrame, dictionary: FeatureDictionary) -> DataFrame:
    """Wide complaint panel from the long form: total_311 and one column per
    complaint type (pivot with an explicit value list, pivot last)."""
    return long.groupBy("business_id", "month").agg(
        F.sum("n").alias("total_311"),
        *[
            F.coalesce(F.sum(F.when(F.col("complaint_type").isin(dictionary.labels_for(c)), F.col("n"))), F.lit(0)).alias(c)
            for c in dictionary.columns
        ],
    )


def merge_panel(
    license_counts: DataFrame,
    complaints: DataFrame,
    located: DataFrame,
    categories: FeatureDictionary,
    complaint_types: FeatureDictionary,
) -> DataFrame:
    """licence counts ⟕ complaints on (id, month), ⋈ located+clustered
    businesses on id (rows of businesses without a location or cluster are
    dropped, as the final panel does), 0-fill, row sums, fixed column order.

    ``license_counts`` has (business_id, month, active_license_count, categories...);
    ``located`` has business_id, first_license_date + LOCATION_FEATURE_COLUMNS
    (one row per business: a single per-business join).
    """
    joined = license_counts.join(complaints, ["business_id", "month"], "left").join(_placed(located), "business_id", "inner")
    return _panel_rows(joined, categories, complaint_types)


def merge_panel_by_business(
    license_counts: MonthCounts,
    complaint_months: DataFrame,
    located: DataFrame,
    categories: FeatureDictionary,
    complaint_types: FeatureDictionary,
) -> DataFrame:
    """``merge_panel`` of complaint counts that come as one row a business:
    (business_id, complaints = map of month to total_311 and the types' counts,
    from ``spatial.BusinessSites.months``).  Businesses are joined once, in the
    tasks that hold their runs of months; the months are made from the joined runs, so that none is sorted."""
    months = _placed(located).join(complaint_months, "business_id", "left").repartition(license_counts.tasks, "business_id")
    joined = _months_of_runs(license_counts.runs.join(months, "business_id", "inner"))
    joined = joined.withColumn("_c", F.try_element_at("complaints", F.col("month")))
    counted = [F.col("_c")[c].alias(c) for c in ("total_311", *complaint_types.columns)]
    return _panel_rows(joined.select("*", *counted).drop("complaints", "_c"), categories, complaint_types)


def _placed(located: DataFrame) -> DataFrame:
    return located.where(
        F.col("location_cluster").isNotNull() & F.col("location_cluster_lat").isNotNull() & F.col("location_cluster_lng").isNotNull()
    )


def _panel_rows(joined: DataFrame, categories: FeatureDictionary, complaint_types: FeatureDictionary) -> DataFrame:
    cat_cols = categories.columns
    cmp_cols = complaint_types.columns

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("long")

    cat_sum = sum((zero(c) for c in cat_cols), F.lit(0).cast("long")) if cat_cols else F.lit(0).cast("long")
    cmp_sum = sum((zero(c) for c in cmp_cols), F.lit(0).cast("long")) if cmp_cols else F.lit(0).cast("long")
    return joined.select(
        "business_id",
        "month",
        F.col("active_license_count").cast("long").alias("active_license_count"),
        *[zero(c).alias(c) for c in cat_cols],
        zero("total_311").alias("total_311"),
        *[zero(c).alias(c) for c in cmp_cols],
        F.lit(1).alias("open"),
        month_diff(F.col("month"), F.col("first_license_date")).cast("int").alias("months_since_first_license"),
        *[F.col(c) for c in LOCATION_FEATURE_COLUMNS],
        cat_sum.alias("business_category_sum"),
        cmp_sum.alias("complaint_sum"),
    )


def sort_panel(panel: DataFrame) -> DataFrame:
    """Rows of a business together and in month order, without a global sort."""
    return panel.repartition("business_id").sortWithinPartitions("business_id", "month")
