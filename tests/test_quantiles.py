import datetime as dt
import random
import statistics

from tenure.operators import panel, quantiles


def test_medians_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice([None, float(rng.randint(-30, 30)), rng.random()])) for _ in range(1500)]
    rows += [("one", 2.5), ("two", 1.0), ("two", 4.0), ("none", None)] + [("hot", float(i)) for i in range(4001)] + [("ties", 7.0)] * 500
    df = spark.createDataFrame(rows, "g string, value double").repartition(7)
    got = {r.g: r.median for r in quantiles.grouped_medians(df, ["g"]).collect()}
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert got == {g: statistics.median(v) for g, v in by.items()}
    wide = spark.createDataFrame([(1.0, None), (2.0, None), (5.0, None), (9.0, None)], "a double, `b.c` double")
    assert quantiles.column_medians(wide, ["a", "b.c"]).first()[:] == (3.5, None)
    assert quantiles.column_medians(wide.limit(0), ["a"]).first()[0] is None


def test_hot_business_has_the_same_location(spark):
    rng = random.Random(6)
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i % 50)
    rows = [(f"b{i % 5}" if i % 3 else "hot", day(i), rng.choice([None, rng.random()]), rng.random()) for i in range(900)]
    rows += [("bare", day(3), None, None)] * 400
    df = spark.createDataFrame(rows, "business_id string, issue_date date, latitude double, longitude double").repartition(6)
    plain = {tuple(r) for r in panel.business_facts(df).collect()}
    assert {tuple(r) for r in panel.business_facts(df, hot_rows=250).collect()} == plain
