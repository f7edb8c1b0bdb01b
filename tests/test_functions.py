import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenure.functions.exprs import month_diff, sanitize_feature_name
from tenure.operators import cleaning, panel, scoring


def test_sanitize_feature_name(spark):
    df = spark.createDataFrame([("Home Improvement Contractor",), ("Heat & Hot Water",), ("  ",), ("O'Neil’s",)], "raw string")
    out = [r[0] for r in df.select(sanitize_feature_name(F.col("raw"), "x")).collect()]
    assert out == ["x_home_improvement_contractor", "x_heat_and_hot_water", "x_unknown", "x_oneils"]


def test_feature_dictionary_suffixes(spark):
    # three labels sanitizing to the same name get a, a_1, a_2 in sorted-label order
    df = spark.createDataFrame([("A B",), ("A-B",), ("a b",), ("Zed",)], "c string")
    d = panel.feature_dictionary(df, "c", "p")
    assert dict(d.raw_to_column) == {"A B": "p_a_b", "A-B": "p_a_b_1", "a b": "p_a_b_2", "Zed": "p_zed"}


def test_reserved_row_sum_name(spark):
    df = spark.createDataFrame([("Sum",), ("Retail",)], "c string")
    d = dict(panel.feature_dictionary(df, "c", "business_category").raw_to_column)
    assert d == {"Sum": "business_category_sum_1", "Retail": "business_category_retail"}


def test_month_range_inclusive(spark):
    rows = panel.month_range(spark, dt.date(2025, 1, 15), dt.date(2025, 3, 2)).collect()
    assert [r.month for r in rows] == [dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 3, 1)]


def test_clean_licenses(spark):
    raw = spark.createDataFrame(
        [
            ("L1", "B1", "Retail", "Active", "1/5/2025", "03/01/2025", "40.7", "-73.9"),
            ("L2", "B2", None, "Active", "01/01/2025", "02/01/2025", "40.7", "-73.9"),
            ("L3", "B3", "Retail", "Active", "03/01/2025", "01/01/2025", "40.7", "-73.9"),
            ("L4", "B4", "Retail", "Active", "02/30/2025", "03/01/2025", "NaN", "1d"),
            ("L5", " nan ", "Retail", "Active", "01/01/2025", "03/01/2025", None, None),
        ],
        "license_number string, business_id string, business_category string, license_status string,"
        " issue_date string, expire_date string, latitude string, longitude string",
    )
    out = cleaning.clean_licenses(raw).collect()
    assert [r.business_id for r in out] == ["B1"]
    assert out[0].issue_month == dt.date(2025, 1, 1) and out[0].expire_month == dt.date(2025, 3, 1)


def test_clean_requests_and_numbers(spark):
    raw = spark.createDataFrame(
        [
            ("100", "1/15/2025 1:02:03 pm", "Noise", "40.7", "-73.9"),
            ("101", "bad", "Noise", "40.7", "-73.9"),
            ("102", "01/15/2025 01:02:03 PM", "  ", "40.7", "-73.9"),
            ("103", "01/15/2025 01:02:03 PM", "Noise", "NaN", "-73.9"),
        ],
        "unique_key string, created_date string, complaint_type string, latitude string, longitude string",
    )
    out = cleaning.clean_service_requests(raw).collect()
    assert [(r.unique_key, r.month) for r in out] == [("100", dt.date(2025, 1, 1))]


def test_month_diff_is_calendar(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31), dt.date(2020, 2, 1))], "a date, b date")
    assert df.select(month_diff(F.col("b"), F.col("a"))).first()[0] == 1


def test_panel_violations(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1)), ("A", dt.date(2020, 1, 1)), ("B", None)], "business_id string, month date")
    for c in ("active_license_count", "total_311", "open", "months_since_first_license", "location_cluster",
              "location_cluster_lat", "location_cluster_lng", "business_latitude", "business_longitude",
              "business_category_sum", "complaint_sum"):
        df = df.withColumn(c, F.lit(0))
    row = cleaning.panel_violations(df).first()
    assert row.duplicate_keys == 1 and row.null_months == 1
    import pytest

    with pytest.raises(ValueError, match="null month"):
        cleaning.validate_panel(df)


def test_flatten_timelines_and_risk_pivot(spark):
    import pytest

    from tenure.operators import scoring

    tp = spark.createDataFrame(
        [("A", 1, 2, 40.7, -73.9, ["business_category_home_improvement_contractor"], {"complaint_type_noise_residential": 3.0, "complaint_type_heat_hot_water": 1.0}),
         ("A", 0, 1, 40.7, -73.9, [], {})],
        "business string, month int, active_license_count int, business_latitude double, business_longitude double,"
        " categories array<string>, complaints map<string,double>",
    )
    rows = scoring.flatten_timelines(tp).collect()
    assert (rows[0].month, rows[0].categories, rows[0].complaint_counts) == (0, "None", "None")
    assert rows[1].categories == "Home Improvement Contractor"
    assert rows[1].complaint_counts == "Heat Hot Water (1), Noise Residential (3)"
    scored = spark.createDataFrame([("A", 1, 0.5), ("B", 1, 2.0), ("A", 2, 0.7), ("C", 2, 9.0)], "business string, month int, partial_hazard double")
    piv = scoring.pivot_risk_over_time(scored, "business", ["A", "B"]).collect()
    assert [(r.month, r.A, r.B) for r in piv] == [(1, 0.5, 2.0), (2, 0.7, None)]
    with pytest.raises(ValueError):
        scoring.pivot_risk_over_time(scored, "business", [str(i) for i in range(2000)])


def test_license_counts_by_category(spark):
    import datetime as dt

    from tenure.operators import panel

    rows = [("L1", "B1", "Cat A", dt.date(2020, 1, 1), dt.date(2020, 3, 1)),
            ("L1", "B1", "Cat B", dt.date(2020, 2, 1), dt.date(2020, 2, 1)),
            ("L2", "B1", "Cat A", dt.date(2020, 1, 1), dt.date(2020, 1, 1)),
            ("L3", "B2", "Cat-A", dt.date(2020, 5, 1), dt.date(2020, 6, 1))]
    lic = spark.createDataFrame(rows, "license_number string, business_id string, business_category string, issue_month date, expire_month date")
    d = panel.feature_dictionary(lic, "business_category", "business_category")
    exp = panel.expand_to_months(lic)
    got = sorted(tuple(r) for r in panel.license_month_counts(exp, d).collect())
    assert len(got) == 5
    # Jan: two licence numbers, Cat A twice; Feb: L1 twice (two categories) counts once
    assert ("B1", dt.date(2020, 2, 1), 1, 1, 0, 1) in got


def _licence_rows():
    d = dt.date
    return [
        ("b1", "L1", "A", d(2024, 1, 1), d(2024, 4, 1)), ("b1", "L1", "B", d(2024, 1, 1), d(2024, 2, 1)), ("b1", "L1", "A", d(2024, 6, 1), d(2024, 6, 1)),
        ("b1", "L1", "A", d(2024, 2, 1), d(2024, 6, 1)), ("b1", "L2", "A", d(2024, 3, 1), d(2024, 5, 1)), ("b1", "L1", "A", d(2024, 1, 1), d(2024, 4, 1)),
        ("b2", "L1", "B", d(2024, 2, 1), d(2024, 2, 1)), ("b3", "L9", "A", d(2023, 12, 1), d(2024, 1, 1)),
    ]


@pytest.mark.parametrize("hot_rows,task_rows", [(100, 100), (3, 2)])
def test_license_counts_by_business_equal_the_expanded_rows(spark, hot_rows, task_rows):
    lic = spark.createDataFrame(_licence_rows(), "business_id string, license_number string, business_category string, issue_month date, expire_month date")
    d = panel.feature_dictionary(lic, "business_category", "business_category")
    want = panel.license_month_counts(panel.expand_to_months(lic), d)
    got = panel.license_month_counts_by_business(lic, d, hot_rows, task_rows)
    assert sorted(map(tuple, got.rows.collect())) == sorted(map(tuple, want.select(*got.rows.columns).collect()))
    assert got.tasks == -(-8 // task_rows)


def test_panel_rows_are_not_shuffled(spark):
    lic = spark.createDataFrame(_licence_rows(), "business_id string, license_number string, business_category string, issue_month date, expire_month date")
    d = panel.feature_dictionary(lic, "business_category", "business_category")
    counts = panel.license_month_counts_by_business(lic, d)
    cmps = panel.FeatureDictionary((("Noise", "complaint_type_noise"),))
    months = spark.sql("select 'b1' business_id, map(date'2024-02-01', struct(3L as total_311, 2L as complaint_type_noise)) complaints")
    located = spark.createDataFrame(
        [("b1", dt.date(2024, 1, 5), 40.7, -74.0, 0, 40.7, -74.0), ("b2", dt.date(2024, 2, 5), 40.7, -74.0, 0, 40.7, -74.0), ("b3", dt.date(2023, 12, 5), 40.7, -74.0, None, None, None)],
        "business_id string, first_license_date date, business_latitude double, business_longitude double, location_cluster int, location_cluster_lat double, location_cluster_lng double",
    )
    got = panel.merge_panel_by_business(counts, months, located, d, cmps)
    wide = months.select("business_id", F.explode("complaints").alias("month", "c")).select("business_id", "month", "c.*")
    want = panel.merge_panel(counts.rows, wide, located, d, cmps)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == want.columns
    plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(business_id" in plan and ", month" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_flatten_timelines_with_known_names(spark):
    tp = spark.createDataFrame(
        [("b", 2, 1, 40.7, -74.0, ["business_category_tow_truck", "business_category_new"], {"complaint_type_noise": 3.0, "complaint_type_heat": 1.0}), ("b", 0, 2, None, None, [], {})],
        "business string, month int, active_license_count long, business_latitude double, business_longitude double, categories array<string>, complaints map<string,double>",
    )
    names = ["business_category_tow_truck", "complaint_type_noise", "complaint_type_noise"]
    got = scoring.flatten_timelines(tp, names)
    assert got.collect() == scoring.flatten_timelines(tp).collect() and [r.month for r in got.collect()] == [0, 2]
    # texts are made after the rows have been moved
    moved = got._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(moved) == 2 and "array_join" in moved[0] and "array_join" not in moved[1]


def test_license_counts_by_business_make_no_licence_months(spark):
    """Overlapping, touching, nested and repeated spans, gaps and null numbers; licences stay unexpanded."""
    import datetime as dt
    import random

    from tenure.operators import panel

    draw = random.Random(5)
    month = lambda k: dt.date(2000 + k // 12, k % 12 + 1, 1)
    rows = []
    for _ in range(400):
        a = draw.randrange(40)
        number = draw.choice([None, *map(str, range(6))])
        rows.append((str(draw.randrange(12)), number, draw.choice(["x", "y", None]), month(a), month(a + draw.choice([0, 1, 3, 30]))))
    lic = spark.createDataFrame(rows, "business_id string, license_number string, business_category string, issue_month date, expire_month date")
    d = panel.feature_dictionary(lic, "business_category", "business_category_")
    want = {tuple(r) for r in panel.license_month_counts(panel.expand_to_months(lic), d).collect()}
    counts = panel.license_month_counts_by_business(lic, d)
    assert [tuple(r) for r in counts.rows.collect()].__len__() == len(want)
    assert {tuple(r) for r in counts.rows.collect()} == want
    changes = panel._month_changes(lic, d)
    assert changes.count() <= 3 * len(rows) < panel.expand_to_months(lic).count()
