import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenure.operators import cox, evaluation, features, logistic, sampling


def test_variance_filter_drops_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0.0), (2.0, 5.0, 1.0), (3.0, 5.0, 0.0)], "a double, b double, c double")
    sel = features.variance_filter(df, ["a", "b", "c"], 1e-8)
    assert sel.kept_columns == ["a", "c"] and sel.dropped_columns == ["b"]
    sc = features.fit_scaler(df, ["a", "b"])
    assert sc.scales[1] == 1.0 and abs(sc.scales[0] - math.sqrt(2 / 3)) < 1e-12  # population std


def test_balance_and_split_sizes(spark):
    df = spark.createDataFrame([(str(i), 1 if i < 4 else 0) for i in range(6)], "business_id string, y int")
    bal = sampling.balance_oversample(df, "y", ["business_id"], 42)
    counts = {r.y: r.n for r in bal.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 4, 1: 4}
    with pytest.raises(ValueError):
        sampling.balance_oversample(df.where("y = 1"), "y", ["business_id"], 42)
    ten = spark.createDataFrame([(str(i), i % 2, -1) for i in range(10)], "business_id string, y int, _copy long")
    train, test = sampling.stratified_split(ten, "y", ["business_id", "_copy"], 0.2, 42)
    tr, te = train.collect(), test.collect()
    assert len(tr) + len(te) == 10 and len(te) == 2
    assert sorted(r.y for r in te) == [0, 1]
    assert not ({r.business_id for r in tr} & {r.business_id for r in te})


def test_dense_index_is_exact(spark):
    df = spark.range(0, 1000).withColumn("h", F.xxhash64("id")).repartition(7)
    idx = sampling.dense_index(df, ["h"]).select("_idx").collect()
    assert sorted(r._idx for r in idx) == list(range(1000))


def test_rank_statistics_match_brute_force(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300), 2)  # many ties
    df = spark.createDataFrame([(int(a), float(b), int(b > 0.5)) for a, b in zip(y, p)], "y int, p double, pred int")
    row = evaluation.evaluate_classifier(df, "y", "p", "pred").first()
    pos, neg = p[y == 1], p[y == 0]
    u = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert row.u_statistic == pytest.approx(u)
    assert row.roc_auc == pytest.approx(u / (len(pos) * len(neg)))
    tp = int(((p > 0.5) & (y == 1)).sum())
    assert row.tp == tp
    assert 0 <= evaluation.mannwhitney_p(row.mannwhitney_z) <= 1


def test_logistic_optimum(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    yv = (x @ np.array([1.0, -2.0, 0.5]) + rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, yv)], "a double, b double, c double, y int")
    sc = features.fit_scaler(df, ["a", "b", "c"])
    model = logistic.fit_logistic(features.standardize(df, sc, keep=["y"]), "y", sc, c=1.0, max_iter=500)
    z = (x - np.array(sc.means)) / np.array(sc.scales)
    w, b = np.array(model.coefficients), model.intercept
    prob = 1 / (1 + np.exp(-(z @ w + b)))
    grad_w = w + 1.0 * z.T @ (prob - yv)  # ½‖w‖² + C Σ loss
    grad_b = (prob - yv).sum()
    assert np.abs(grad_w).max() < 1e-3 and abs(grad_b) < 1e-3
    scored = logistic.predict_logistic(df, model).select("probability").collect()
    assert np.allclose([r.probability for r in scored], prob)


def _dense_cox(z_raw, start, stop, ev, pen):
    n, d = z_raw.shape
    mean = z_raw.mean(0)
    std = z_raw.std(0, ddof=1)
    z = (z_raw - mean) / std
    b = np.zeros(d)
    for _ in range(50):
        w = np.exp(z @ b)
        g, h = np.zeros(d), np.zeros((d, d))
        for t in np.unique(stop[ev == 1]):
            r = (start < t) & (stop >= t)
            dd = (stop == t) & (ev == 1)
            k = dd.sum()
            s0, s1, s2 = w[r].sum(), (w[r, None] * z[r]).sum(0), (z[r].T * w[r]) @ z[r]
            a0, a1, a2 = w[dd].sum(), (w[dd, None] * z[dd]).sum(0), (z[dd].T * w[dd]) @ z[dd]
            g += z[dd].sum(0)
            for l in range(k):
                f = l / k
                phi, z1, z2 = s0 - f * a0, s1 - f * a1, s2 - f * a2
                g -= z1 / phi
                h -= z2 / phi - np.outer(z1, z1) / phi**2
        g -= pen * n * b
        h -= pen * n * np.eye(d)
        step = np.linalg.solve(-h, g)
        b += step
        if np.linalg.norm(step) < 1e-12:
            break
    return b / std, np.sqrt(np.diag(np.linalg.inv(-h))) / std


@pytest.mark.parametrize("tv", [False, True])
def test_cox_matches_dense_efron(spark, tv):
    rng = np.random.default_rng(5)
    n = 200
    x = rng.normal(size=(n, 2))
    stop = rng.integers(1, 12, n).astype(float)  # heavy ties
    start = stop - 1 if tv else np.full(n, -np.inf)
    ev = (rng.random(n) < 0.6).astype(float)
    rows = [(float(a), float(b), float(s), float(t), float(e)) for (a, b), s, t, e in zip(x, start, stop, ev)]
    df = spark.createDataFrame(rows, "a double, b double, start double, stop double, event double").repartition(4)
    model = cox.fit_cox(df, ["a", "b"], "stop", "event", start_col="start" if tv else None, penalizer=0.1)
    b, se = _dense_cox(x, start, stop, ev, 0.1)
    assert np.allclose(model.coefficients, b, atol=1e-9)
    assert np.allclose(np.sqrt(np.diag(model.variance)), se, atol=1e-9)
    rows = model.summary_rows()
    assert all(abs(r[9] - r[1] / r[3]) < 1e-12 for r in rows)  # z = coef / se


def test_inspection_jobs(spark):
    import datetime as dt

    from tenure.config import ModelSettings
    from tenure.plans import registry as R
    from tenure.plans.cox_job import run_cox
    from tenure.plans.inspect_job import inspect_cox, inspect_logistic
    from tenure.plans.logistic_job import run_logistic

    sf = "/root/testdata/sf0.001"
    panel = R._panel_core(spark, sf)
    for c in ("location_cluster", "location_cluster_lat", "location_cluster_lng"):
        panel = panel.withColumn(c, F.lit(0).cast("double") if c != "location_cluster" else F.lit(0))
    settings = ModelSettings(study_end=dt.date(2001, 1, 1))
    ins = inspect_logistic(run_logistic(panel, settings))
    assert ins.scores.count() == 8 and ins.checks.count() == 7
    many = ins.checks.where(F.col("profile") == "many_licenses").first()
    assert many.expected_vs_baseline in ("above_baseline", "below_baseline", "same_as_baseline")
    runs = run_cox(panel, settings)
    ic = inspect_cox(runs["standard"], panel, settings.study_end)
    row = ic.scores.where(F.col("profile") == "baseline").first()
    assert row.ratio_to_baseline == pytest.approx(1.0) and 0 < row.survival_prob_12m <= 1
    with pytest.raises(ValueError, match="not kept"):
        inspect_cox(runs["standard"], panel, settings.study_end, strict=True)  # scenario categories absent here


def test_baseline_interpolation():
    import pandas as pd

    m = cox.CoxModel(["a"], np.zeros(1), np.eye(1), np.zeros(1), 0.0, 0, 10,
                     baseline=pd.DataFrame({"time": [1.0, 3.0], "baseline_hazard": [0.1, 0.2], "baseline_cumulative_hazard": [0.1, 0.3]}))
    assert cox.baseline_cumulative_hazard_at(m, 0) == 0.1
    assert cox.baseline_cumulative_hazard_at(m, 2) == pytest.approx(0.2)
    assert cox.baseline_cumulative_hazard_at(m, 3) == pytest.approx(0.3)
    assert cox.baseline_cumulative_hazard_at(m, 120) == pytest.approx(0.3)


def test_balance_train_only_keeps_test_split_unbalanced(spark):
    import datetime as dt

    from tenure.config import ModelSettings
    from tenure.plans import registry as R
    from tenure.plans.logistic_job import run_logistic

    panel = R._panel_core(spark, "/root/testdata/sf0.001")
    for c in ("location_cluster", "location_cluster_lat", "location_cluster_lng"):
        panel = panel.withColumn(c, F.lit(0))
    run = run_logistic(panel, ModelSettings(study_end=dt.date(2001, 1, 1), balance="train_only"))
    test_ids = [r.business_id for r in run.test.select("business_id").collect()]
    assert len(test_ids) == len(set(test_ids))  # no oversampled copies leak into the test split
    counts = {r.survived_36m: r.n for r in run.train.groupBy("survived_36m").agg(F.count("*").alias("n")).collect()}
    assert len(counts) == 2 and len(set(counts.values())) == 1
    auc = run.metrics["roc_auc"]
    assert auc is None or 0.0 <= auc <= 1.0  # undefined when the test split holds one class


def test_rank_statistics_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3, 0), (1, 0.9, 1)], "y int, p double, pred int")
    row = evaluation.evaluate_classifier(df, "y", "p", "pred").first()
    assert row.roc_auc is None and row.mannwhitney_z is None and row.tp == 1
    one = evaluation.evaluate_classifier(df.limit(1), "y", "p", "pred").first()
    assert one.roc_auc is None


def test_cox_says_whether_it_converged(spark):
    rng = np.random.default_rng(6)
    rows = [(float(a), float(t), float(e)) for a, t, e in zip(rng.normal(size=80), rng.integers(1, 9, 80), rng.random(80) < 0.6)]
    df = spark.createDataFrame(rows, "a double, stop double, event double")
    whole, cut = (cox.fit_cox(df, ["a"], "stop", "event", max_steps=k) for k in (50, 1))
    assert whole.converged and not cut.converged
    assert [r.converged for r in cox.summary_frame(spark, cut).collect()] == [False]


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 80, 81, 200, 1000, 4097, 50_000])
def test_tie_rule_equals_the_loop(n):
    l = np.arange(n)  # noqa: E741
    nodes, weights = cox.tie_rule(n)
    assert len(nodes) <= 64 + 16 * 20 and np.isclose(weights.sum(), n, rtol=1e-13)
    for share in (1.0, 1 - 1e-9, 0.9, 0.3, 1e-3, 1e-8):  # A / S
        phi, fast = 1.7 * (1 - share * l / n), 1.7 * (1 - share * nodes / n)
        for power in range(3):
            for down in (1, 2):
                assert np.isclose(weights @ ((nodes / n) ** power / fast**down), ((l / n) ** power / phi**down).sum(), rtol=1e-11, atol=1e-12)
        assert np.isclose(weights @ np.log(fast), np.log(phi).sum(), rtol=1e-11, atol=1e-9)


def test_tie_rule_stays_short():
    nodes, weights = cox.tie_rule(10**12)
    assert len(nodes) < 700 and np.isclose(weights.sum(), 1e12, rtol=1e-12)


@pytest.mark.parametrize("tv", [False, True])
def test_risk_set_sums(spark, tv):
    rng = np.random.default_rng(9)
    n = 300
    x = rng.normal(size=(n, 2))
    stop = rng.integers(1, 9, n).astype(float)
    start = stop - rng.integers(1, 4, n)
    ev = (rng.random(n) < 0.4).astype(float)
    rows = [(float(a), float(b), float(s), float(t), float(e)) for (a, b), s, t, e in zip(x, start, stop, ev)]
    df = spark.createDataFrame(rows, "a double, b double, start double, stop double, event double").repartition(5)
    got = cox.risk_set_sums(df, {"a": 0.4, "b": -0.3}, "stop", "event", "start" if tv else None).collect()
    w = np.exp(x @ np.array([0.4, -0.3]))
    assert [r.time for r in got] == sorted(set(stop[ev == 1]))
    for r in got:
        at = (stop >= r.time) & ((start < r.time) if tv else True)
        assert r.n_events == int(ev[stop == r.time].sum())
        assert np.allclose([r.s0, r.s1_a, r.s1_b], [w[at].sum(), *(w[at, None] * x[at]).sum(0)])


def test_cox_scenarios_find_the_baseline_once(spark, tmp_path):
    import datetime as dt

    from tenure.operators import scoring

    rows = [("b", dt.date(2024, 1, 1), 2, 1), ("a", dt.date(2024, 2, 1), 5, 0), ("a", dt.date(2024, 1, 1), 7, 1)]
    path = str(tmp_path / "panel")
    spark.createDataFrame(rows, "business_id string, month date, active_license_count long, business_category_x long").write.parquet(path)
    kept = ["active_license_count", "business_category_x"]
    got = scoring.scenario_profiles_cox(scoring.baseline_first_row(spark.read.parquet(path), kept), kept, 3)
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    found = {r.profile: (r.active_license_count, r.business_category_x) for r in got.collect()}
    assert len(found) == 5 and found["baseline"] == (7.0, 1.0) and found["multi_license_business"] == (3.0, 1.0)


def test_evaluation_makes_the_scores_once(spark):
    from pyspark.sql import functions as F

    from tenure.operators import evaluation

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(40).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") / 40).alias("p"), (F.col("id") > 20).cast("int").alias("d"))
    row = evaluation.evaluate_classifier(rows.mapInArrow(counted, rows.schema), "y", "p", "d").first()
    assert row["support_0"] + row["support_1"] == 40
    assert made.value == 40


@pytest.mark.parametrize("few_times", [True, False])
def test_cox_reads_spans_not_months(spark, monkeypatch, few_times):
    """Months without a change are one row of the fit; one pass a step with few times; same coefficients as the dense fit."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(120):
        x, at = rng.normal(size=2), 0
        for month in range(int(rng.integers(3, 14))):
            if rng.random() < 0.2:
                x = rng.normal(size=2)
            rows.append([*x, at, at + 1, 0.0])
            at += 1
        rows[-1][4] = float(rng.random() < 0.7)
    v = np.array(rows)
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, start double, stop double, event double").coalesce(1)
    saved, passes, real, second = [], [], cox._spans, cox._pass_b
    monkeypatch.setattr(cox, "_spans", lambda *args: saved.append(real(*args)) or saved[-1])
    monkeypatch.setattr(cox, "_pass_b", lambda *args: passes.append(1) or second(*args))
    if not few_times:
        monkeypatch.setattr(cox, "MOST_SECONDS", 0)
    model = cox.fit_cox(df, ["a", "b"], "stop", "event", start_col="start", penalizer=0.1)
    b, se = _dense_cox(v[:, :2], v[:, 2], v[:, 3], v[:, 4], 0.1)
    assert np.allclose(model.coefficients, b, atol=1e-9) and np.allclose(np.sqrt(np.diag(model.variance)), se, atol=1e-9)
    got = saved[0].agg(F.count("*").alias("spans"), F.sum("rows").alias("rows")).first()
    assert got["rows"] == model.n_rows == len(rows) and got["spans"] < 0.5 * len(rows)
    assert bool(passes) != few_times


def test_filter_and_scale_is_both_steps(spark):
    for rows in ([(1.0, 5.0, 0.0), (2.0, 5.0, 1.0), (4.0, 5.0, 1.0)], [(1.0, 5.0, None), (2.0, None, 1.0), (4.0, 5.0, 3.0)]):
        df = spark.createDataFrame(rows, "a double, b double, c double")
        sel, scaler = features.filter_and_scale(df, ["a", "b", "c"], 1e-8)
        want = features.variance_filter(df, ["a", "b", "c"], 1e-8)
        assert sel == want and scaler == features.fit_scaler(df, want.kept_columns)
    with pytest.raises(ValueError):
        features.filter_and_scale(df.limit(0), ["a"], 1e-8)


def test_kmeans_blocks_equal_all_distances():
    from tenure.operators import clustering

    rng = np.random.default_rng(9)
    for n in (1, 63, 5000):
        x = rng.random((n, 2))
        x = x[np.lexsort((x[:, 1], np.floor(x[:, 0] * 9)))]
        w = rng.integers(1, 5, n).astype(float)
        for centres in (rng.random((25, 2)), np.round(x[: min(n, 9)], 1), np.zeros((3, 2))):
            assert np.allclose(clustering._Blocks(x, w).sums(centres), clustering._sums(x, w, centres), atol=1e-8)


def test_panel_and_its_intervals_move_no_month(spark):
    """The panel's months are made after its join and saved by business: neither they nor the model's intervals are shuffled."""
    from tenure.operators import survival
    from tenure.plans import panel, registry
    from tenure.sources import fixtures

    sf = "/root/testdata/sf0.001"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = panel.build_panel_parts(fixtures.licenses(spark, sf), fixtures.requests(spark, sf), centres=registry.O.FIXED_CENTRES)
        plan = parts.panel._jdf.queryExecution().executedPlan().toString()
        assert plan.index("explode(sequence(") < plan.index("Join")
        intervals = survival.time_varying_panel(registry._full_panel(spark, sf), registry.FIXTURE_STUDY_END)
        assert "Exchange" not in intervals._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_business_rows_are_made_once(spark):
    """The standard model's rows are saved before they are filtered and scaled, not made again for each step."""
    from tenure.config import ModelSettings
    from tenure.plans import registry
    from tenure.plans.cox_job import prepare_business_level

    settings = ModelSettings(study_end=registry.FIXTURE_STUDY_END)
    modeling, sel, _ = prepare_business_level(registry._panel_core(spark, "/root/testdata/sf0.001"), settings)
    plan = modeling._jdf.queryExecution().executedPlan().toString()
    assert "business-level" in plan and "Aggregate" not in plan and modeling.count() > 0 and sel.kept_columns
