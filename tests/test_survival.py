import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenure.operators import survival


def _months(start, n):
    y, m = start.year, start.month
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def test_eligibility(spark):
    s = spark.createDataFrame(
        [("A", dt.date(2020, 1, 1), dt.date(2025, 1, 1)), ("B", dt.date(2024, 1, 1), dt.date(2026, 1, 1)), ("C", dt.date(2022, 1, 1), dt.date(2022, 6, 1))],
        "business_id string, first_month date, last_month date",
    )
    out = survival.eligible_businesses(s, dt.date(2026, 3, 1), 36, 12).collect()
    assert [r.business_id for r in out] == ["A"]


def test_first_year_window(spark):
    rows = [("A", m, i) for i, m in enumerate(_months(dt.date(2020, 1, 1), 14))]
    rows += [("B", m, i) for i, m in enumerate(_months(dt.date(2021, 1, 1), 8))]
    df = spark.createDataFrame(rows, "business_id string, month date, value long")
    counts = {r.business_id: r.n for r in survival.first_year_window(df, 12).groupBy("business_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"A": 12, "B": 8}


def test_binary_and_rules(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 2), (0, None), (None, None)], "a int, b int")
    assert survival.binary_columns(df, ["a", "b"]) == {"a": True, "b": False}
    assert survival.rule_for("business_category_test") == "max"
    assert survival.rule_for("complaint_type_noise") == "sum"
    assert survival.rule_for("active_license_count") == "mean"
    assert survival.rule_for("business_latitude") == "first"
    assert survival.rule_for("other", True) == "max" and survival.rule_for("other", False) == "last"
    with pytest.raises(ValueError):
        survival.rule_for("month")


def test_first_year_aggregate(spark):
    df = spark.createDataFrame(
        [
            ("A", dt.date(2020, 1, 1), 1, 0, 2, 40.1, None),
            ("A", dt.date(2020, 2, 1), 3, 1, None, 40.2, 5.0),
            ("A", dt.date(2020, 3, 1), 2, 0, 1, 40.3, None),
            ("B", dt.date(2021, 1, 1), 1, 0, 0, 40.5, 1.0),
            ("B", dt.date(2021, 2, 1), 1, 0, 0, 40.6, 2.0),
        ],
        "business_id string, month date, active_license_count int, business_category_x int,"
        " complaint_type_y int, business_latitude double, other double",
    )
    out = {r.business_id: r for r in survival.first_year_aggregate(df, 12).collect()}
    a = out["A"]
    assert a.active_license_count_first12m_mean == 2.0
    assert a.business_category_x_first12m_max == 1
    assert a.complaint_type_y_first12m_sum == 3
    assert a.business_latitude_first12m_first == 40.1
    assert a.other_first12m_last == 5.0  # last non-null
    assert a.observed_months_in_first_window == 3
    assert out["B"].other_first12m_last == 2.0


def test_time_varying_panel_invariants(spark):
    rows = [("A", m, i, 1, 0, 0, 0, 0, 0) for i, m in enumerate(_months(dt.date(2020, 1, 1), 5))]
    rows += [("B", m, i, 1, 0, 0, 0, 0, 0) for i, m in enumerate(_months(dt.date(2025, 10, 1), 8))]
    df = spark.createDataFrame(
        rows, "business_id string, month date, months_since_first_license int, open int, total_311 long,"
        " complaint_sum long, business_category_sum long, location_cluster int, active_license_count int"
    )
    tv = survival.time_varying_panel(df, dt.date(2026, 3, 1))
    assert "open" not in tv.columns and "location_cluster" not in tv.columns
    rows = tv.collect()
    assert all(r.stop >= r.start and r.event in (0, 1) for r in rows)
    ev = {r.business_id: sum(x.event for x in rows if x.business_id == r.business_id) for r in rows}
    assert ev == {"A": 1, "B": 0}  # B runs to the study end: censored
    first = [r for r in rows if r.business_id == "A" and r.months_since_first_license == 0] if "months_since_first_license" in tv.columns else [r for r in rows if r.business_id == "A" and r.stop == 0]
    assert first[0].start == -1
    bl = {r.business_id: r for r in survival.business_level_dataset(df, dt.date(2026, 3, 1)).collect()}
    assert (bl["A"].duration_months, bl["A"].event) == (4, 1)
    assert (bl["B"].duration_months, bl["B"].event) == (5, 0)


def test_training_shuffles_no_panel_rows(spark):
    """The panel is saved by business, so that its groups and windows by business read whole groups."""
    from tenure.plans import registry

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        training = registry._training(spark, "/root/testdata/sf0.001")
        assert "Exchange" not in training._jdf.queryExecution().executedPlan().toString()
        assert training.count() == training.select("business_id").distinct().count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
