"""Penalised Cox proportional hazards (standard and time-varying) with
Efron ties, fitted by Newton-Raphson over distributed sufficient statistics.

Rows are ``(start, stop, event, x)``; a row is at risk at event time t when
``start < t <= stop`` (standard model: no start, i.e. ``duration >= t``).

Rows that follow each other with the same features and no event between are one span
(``_spans``): the same weights are at risk at every time.  Per Newton iteration, passes over
the spans (saved as Parquet):

A. per distinct time: S0 = Σ w, S1 = Σ w·x over rows with that stop (and,
   negated, over rows with that start), plus event count, Σ x and Σ w, Σ w·x
   over the events.  Partitions emit partial sums (``mapInArrow``), a
   ``groupBy(kind, time)`` adds them in the JVM.  Driver state: times × d (× d where B is not run).
B. the second-order term Σ_t Σ_l (S2 - l/d·A2)/φ_l collapses into one
   weighted Gram matrix Σ_i ω_i x_i x_iᵀ with ω_i = w_i (C(stop_i) - C(start_i)
   - event_i·e(stop_i)), where C and e are per-time scalars from pass A; one
   d×d partial per partition, summed in a two-level reduction.  With few
   distinct times (``MOST_SECONDS``) pass A brings Σ w·x·xᵀ per time, too, and B is not run.

Risk sets are suffix sums over times on the driver (bounded by the number of
distinct times).  Penalty: ½·penalizer·n·‖β‖² on internally normalised
features (sample std), as the reference's library does; coefficients and
their variance are mapped back to the input scale.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Z95 = 1.959963984540054
MOST_SECONDS = 4_000_000  # numbers of second-order sums by time that may reach the driver


@dataclass
class CoxModel:
    features: list[str]
    coefficients: np.ndarray
    variance: np.ndarray
    norm_mean: np.ndarray
    log_likelihood: float
    iterations: int
    n_rows: int
    baseline: pd.DataFrame | None = None  # time, baseline_hazard, baseline_cumulative_hazard
    extra: dict = field(default_factory=dict)
    converged: bool = True  # False where the step limit ended the fit

    def summary_rows(self) -> list[tuple]:
        se = np.sqrt(np.diag(self.variance))
        rows = []
        for name, b, s in zip(self.features, self.coefficients, se):
            z = b / s if s > 0 else float("nan")
            p = math.erfc(abs(z) / math.sqrt(2.0)) if s > 0 else float("nan")
            lo, hi = b - Z95 * s, b + Z95 * s
            rows.append(
                (name, float(b), math.exp(b), float(s), float(lo), float(hi), math.exp(lo), math.exp(hi), 0.0,
                 float(z), float(p), float(-math.log2(p)) if p > 0 else float("inf"), abs(float(b)), self.converged)
            )
        return rows


SUMMARY_SCHEMA = (
    "feature string, coef double, exp_coef double, se_coef double, coef_lower_95 double, coef_upper_95 double, "
    "exp_coef_lower_95 double, exp_coef_upper_95 double, cmp_to double, z double, p double, neg_log2_p double, abs_coef double, converged boolean"
)


def summary_frame(spark, model: CoxModel) -> DataFrame:
    """Coefficient summary ordered by |coef| descending."""
    return spark.createDataFrame(model.summary_rows(), SUMMARY_SCHEMA).orderBy(F.desc("abs_coef"), "feature")


# ------------------------------------------------------------- tied events --
_DIRECT, _NODES = 64, 16  # terms summed one by one; nodes of a longer block


def _block_rule(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights of the sum over 0..m-1 (Gauss rule of the uniform
    discrete measure: the eigenvalues of the Gram polynomials' recurrence)."""
    j = np.arange(1, _NODES, dtype=float)
    off = np.sqrt(j * j * (float(m) * m - j * j) / (4.0 * (4.0 * j * j - 1.0)))
    nodes, vectors = np.linalg.eigh(np.diag(np.full(_NODES, (m - 1) / 2.0)) + np.diag(off, 1) + np.diag(off, -1))
    return nodes, m * vectors[0] ** 2


@lru_cache(maxsize=4096)
def tie_rule(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes l and weights w with Σ_{l<d} f(l) = Σ w·f(l) for the Efron terms.

    The terms are smooth functions of l whose pole lies at or beyond d.  The
    last 64 are taken one by one; before them come blocks that double in
    length, each at least its own length away from the pole, so 16 nodes
    a block give the sum to machine precision.  The length is of the order
    of log d."""
    lo = max(0, d - _DIRECT)
    nodes, weights = [np.arange(lo, d, dtype=float)], [np.ones(d - lo)]
    size = _DIRECT
    while lo > 0:
        m = min(size, lo)
        lo, size = lo - m, size * 2
        x, w = (np.arange(m, dtype=float), np.ones(m)) if m <= _NODES else _block_rule(m)
        nodes.append(lo + x)
        weights.append(w)
    return np.concatenate(nodes[::-1]), np.concatenate(weights[::-1])


# ----------------------------------------------------------------- pass A --
@dataclass
class TimeSums:
    """Sums per distinct time, in order: weights, weighted features, events
    and their sums (Σ w, Σ w·x, Σ x over the events); where asked for, the upper triangles of Σ w·x·xᵀ
    over the rows and over the events."""

    time: np.ndarray
    s0: np.ndarray
    s1: np.ndarray
    d: np.ndarray
    a0: np.ndarray
    a1: np.ndarray
    xd: np.ndarray
    s2: np.ndarray
    a2: np.ndarray

    @staticmethod
    def of(rows: list, d: int, m: int) -> "TimeSums":
        v = np.array([list(r)[1:] for r in sorted(rows, key=lambda r: r["time"])], dtype=float).reshape(len(rows), 4 + 3 * d + 2 * m)
        first, second = v[:, 4:4 + 3 * d], v[:, 4 + 3 * d:]
        return TimeSums(v[:, 0], v[:, 1], first[:, :d], v[:, 2].astype(np.int64), v[:, 3], first[:, d:2 * d], first[:, 2 * d:], second[:, :m], second[:, m:])


def _columns(batches, names: list[str], least: int = 1 << 16):
    """Arrow batches as matrices of at least ``least`` rows (but the last), a column a name."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1, dtype=float))
            n += batch.num_rows
        if n >= least:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def _by_time(t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by time, where each time starts in it, and the times."""
    order = np.argsort(t, kind="stable")
    ts = t[order]
    starts = np.flatnonzero(np.r_[True, ts[1:] != ts[:-1]])
    return order, starts, ts[starts]


def _pass_a(
    data: DataFrame, features: list[str], beta: np.ndarray, mean: np.ndarray, std: np.ndarray, has_start: bool, second: bool = False
) -> dict:
    d = len(features)
    upper = np.triu_indices(d)
    m = len(upper[0]) if second else 0
    cols = features + ["stop", "event"] + (["start"] if has_start else [])

    def part(it):
        # one vector of sums by (kind, time) over all batches of the partition:
        # s0, events, a0, s1, a1, xd, s2, a2
        sums: dict = {}

        def add(kind, times, at, values):
            for t, v in zip(times, values):
                if (kind, t) not in sums:
                    sums[kind, t] = np.zeros(3 + 3 * d + 2 * m)
                sums[kind, t][at : at + len(v)] += v

        def seconds(kind, times, starts, x, wx, at):
            for t, a, b in zip(times, starts, [*starts[1:], len(x)]):
                sums[kind, t][at : at + m] += (x[a:b].T @ wx[a:b])[upper]

        for rows in _columns(it, cols):
            x = (rows[:, :d] - mean) / std
            w = np.exp(x @ beta)
            for kind, col in ((1, d), (0, d + 2))[: 1 + has_start]:
                order, starts, times = _by_time(rows[:, col])
                xs = x[order]
                wx = xs * w[order, None]
                add(kind, times, 0, np.add.reduceat(w[order], starts)[:, None])
                add(kind, times, 3, np.add.reduceat(wx, starts, axis=0))
                if m:
                    seconds(kind, times, starts, xs, wx, 3 + 3 * d)
            hit = np.flatnonzero(rows[:, d + 1])
            if len(hit):
                order, starts, times = _by_time(rows[hit, d])
                hit = hit[order]
                ev, xs = rows[hit, d + 1], x[hit]
                wx = xs * (w[hit] * ev)[:, None]
                add(1, times, 1, np.add.reduceat(np.c_[ev, w[hit] * ev], starts, axis=0))
                add(1, times, 3 + d, np.add.reduceat(np.c_[wx, xs * ev[:, None]], starts, axis=0))
                if m:
                    seconds(1, times, starts, xs, wx, 3 + 3 * d + m)
        if sums:
            kinds, times = zip(*sums)
            yield pa.RecordBatch.from_pydict(
                {"kind": pa.array(kinds, pa.int32()), "time": pa.array(times, pa.float64()), "v": pa.array(list(sums.values()), pa.list_(pa.float64()))}
            )

    partial = data.select(*cols).mapInArrow(part, "kind int, time double, v array<double>")
    # the partitions' vectors are added position by position in the JVM
    total = partial.groupBy("kind", "time").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(3 + 3 * d + 2 * m)])
    rows = total.collect()
    return {
        kind: TimeSums.of([r for r in rows if r["kind"] == k], d, m)
        for kind, k in (("stop", 1), ("start", 0))
    }


def _suffix(sums: TimeSums, times: np.ndarray):
    """Σ over rows with key >= t, for each t in ``times`` (both sorted)."""
    c0 = np.concatenate([np.cumsum(sums.s0[::-1])[::-1], [0.0]])
    c1 = np.vstack([np.cumsum(sums.s1[::-1], axis=0)[::-1], np.zeros((1, sums.s1.shape[1]))])
    idx = np.searchsorted(sums.time, times, side="left")
    return c0[idx], c1[idx]


def risk_sums(stats: dict, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """S0 and S1 of the rows at risk at each of ``times``."""
    s0, s1 = _suffix(stats["stop"], times)
    if len(stats["start"].time):
        # rows whose start is >= t are not yet at risk at t
        q0, q1 = _suffix(stats["start"], times)
        s0, s1 = s0 - q0, s1 - q1
    return s0, s1


def _second_term(stats: dict, ef: dict, d: int) -> np.ndarray:
    """Σ_t C(t)·S2(t) - e(t)·A2(t) from the sums per time: what ``_pass_b`` gives."""
    stop, start = stats["stop"], stats["start"]
    upper = np.triu_indices(d)
    cum = np.concatenate([[0.0], np.cumsum(ef["C"])])  # Σ C(t) for t <= each time
    upto = lambda times: cum[np.searchsorted(ef["times"], times, side="right")]
    total = upto(stop.time) @ stop.s2 - ef["e"] @ stop.a2[stop.d > 0]
    if len(start.time):
        total -= upto(start.time) @ start.s2
    out = np.zeros((d, d))
    out[upper] = total
    return out + np.triu(out, 1).T


def _efron(stats: dict) -> dict:
    """Log-likelihood, gradient, the first-moment part of the Hessian and the
    per-time scalars C(t) = Σ_l 1/φ_l, e(t) = Σ_l (l/d)/φ_l."""
    stop = stats["stop"]
    has = stop.d > 0
    times = stop.time[has]
    r_s0, r_s1 = risk_sums(stats, times)
    n = r_s1.shape[1]
    ll, grad, h1 = 0.0, np.zeros(n), np.zeros((n, n))
    c_t, e_t = np.zeros(len(times)), np.zeros(len(times))
    for k, (dk, a0, a1, xd) in enumerate(zip(stop.d[has], stop.a0[has], stop.a1[has], stop.xd[has])):
        nodes, weights = tie_rule(int(dk))
        frac = nodes / dk
        phi = r_s0[k] - frac * a0
        inv = weights / phi
        c_t[k] = inv.sum()
        e_t[k] = (frac * inv).sum()
        s1 = r_s1[k]
        grad += xd - (s1 * c_t[k] - a1 * e_t[k])
        inv2 = inv / phi
        q0, q1, q2 = inv2.sum(), (frac * inv2).sum(), (frac * frac * inv2).sum()
        h1 += np.outer(s1, s1) * q0 - (np.outer(s1, a1) + np.outer(a1, s1)) * q1 + np.outer(a1, a1) * q2
        ll -= float(weights @ np.log(phi))
    return {"times": times, "ll_tail": ll, "grad": grad, "h1": h1, "C": c_t, "e": e_t, "xd": stop.xd.sum(axis=0)}


# ----------------------------------------------------------------- pass B --
def _pass_b(data: DataFrame, features: list[str], beta, mean, std, has_start, times, c_t, e_t) -> np.ndarray:
    d = len(features)
    cum = np.concatenate([[0.0], np.cumsum(c_t)])  # cum[j] = Σ_{k<j} C(t_k)
    upper = np.triu_indices(d)

    def weight_sum(tvals):
        return cum[np.searchsorted(times, tvals, side="right")]  # Σ C(t) for t <= tvals

    def part(it):
        acc = np.zeros((d, d))
        seen = False
        for pdf in it:
            if pdf.empty:
                continue
            seen = True
            x = (pdf[features].to_numpy(dtype=float) - mean) / std
            w = np.exp(x @ beta)
            stop = pdf["stop"].to_numpy(dtype=float)
            cc = weight_sum(stop)
            if has_start:
                cc = cc - weight_sum(pdf["start"].to_numpy(dtype=float))
            ev = pdf["event"].to_numpy(dtype=float)
            et = np.zeros(len(stop))
            if len(times):
                # an event row's stop is itself an event time
                pos = np.minimum(np.searchsorted(times, stop), len(times) - 1)
                et = np.where(ev > 0, e_t[pos], 0.0)
            omega = w * (cc - et)
            acc += (x * omega[:, None]).T @ x
        if seen:
            yield pd.DataFrame({"m": [acc[upper]]})

    cols = features + ["stop", "event"] + (["start"] if has_start else [])
    partial = data.select(*cols).mapInPandas(part, "m array<double>")
    # the partitions' triangles are added position by position in the JVM
    rows = partial.select(F.posexplode("m").alias("pos", "x")).groupBy("pos").agg(F.sum("x").alias("x")).collect()
    total = np.zeros((d, d))
    for r in rows:
        total[upper[0][r["pos"]], upper[1][r["pos"]]] = r["x"]
    return total + np.triu(total, 1).T


def _moments(data: DataFrame, features: list[str]) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Mean and sample deviation of each feature, rows (a span counts as the rows it stands for), and about how many times there are."""
    n = F.sum("rows")
    row = data.agg(n.alias("n"), F.approx_count_distinct("stop").alias("times"), *[F.sum(F.col(c) * F.col("rows")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    rows = int(row["n"] or 0)
    mean = np.array([(row[f"m{i}"] or 0.0) / max(1, rows) for i in range(len(features))], dtype=float)
    away = [F.sum(F.pow(F.col(c) - F.lit(float(m)), 2) * F.col("rows")).alias(f"s{i}") for i, (c, m) in enumerate(zip(features, mean))]
    spread = data.agg(F.lit(0), *away).first() if features else []
    std = np.sqrt(np.array([spread[i + 1] or 0.0 for i in range(len(features))], dtype=float) / max(1, rows - 1))
    std[std == 0] = 1.0
    return mean, std, rows, int(row["times"])


def _spans(data: DataFrame, features: list[str]) -> DataFrame:
    """Rows that follow each other, alike in all features and without an event between, as one: at every time the
    same weights are at risk.  ``rows`` says how many rows a span stands for."""
    d = len(features)

    def run(batches):
        for v in _columns(batches, [*features, "stop", "event", "start"]):
            like = (v[1:, :d] == v[:-1, :d]).all(axis=1) & (v[1:, d + 2] == v[:-1, d]) & (v[:-1, d + 1] == 0)
            first = np.flatnonzero(np.r_[True, ~like])
            last = np.r_[first[1:] - 1, len(v) - 1]
            out = [*v[first, :d].T, v[last, d], v[last, d + 1], v[first, d + 2], last - first + 1]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)

    names = [*features, "stop", "event", "start", "rows"]
    kinds = ", ".join([*(f"`{c}` double" for c in names[:-1]), "rows long"])
    return data.select(*names[:-1]).mapInArrow(run, kinds)


def fit_cox(
    data: DataFrame,
    features: list[str],
    stop_col: str,
    event_col: str,
    start_col: str | None = None,
    penalizer: float = 0.1,
    max_steps: int = 50,
    precision: float = 1e-9,
    baseline: bool = False,
) -> CoxModel:
    """Fit the penalised Cox model; ``start_col`` None = standard model."""
    cols = [F.col(c).cast("double").alias(c) for c in features]
    cols += [F.col(stop_col).cast("double").alias("stop"), F.col(event_col).cast("double").alias("event")]
    if start_col:
        cols.append(F.col(start_col).cast("double").alias("start"))
    from tenure.operators.sampling import _saved

    rows = data.select(*cols)
    # the baseline hazard has all stop times, so there no rows become one
    rows = _spans(rows, features) if start_col and not baseline else rows.withColumn("rows", F.lit(1).cast("long"))
    model_data = _saved(rows, "cox-rows")  # every pass reads it: columns, not rows
    mean, std, n, times = _moments(model_data, features)
    d = len(features)
    has_start = start_col is not None
    second = times * d * (d + 1) <= MOST_SECONDS
    beta = np.zeros(d)

    def evaluate(b):
        stats = _pass_a(model_data, features, b, mean, std, has_start, second)
        ef = _efron(stats)
        ll = float(ef["xd"] @ b) + ef["ll_tail"] - 0.5 * penalizer * n * float(b @ b)
        return ll, ef, stats

    def second_term(b, ef, stats):
        if second:
            return _second_term(stats, ef, d)
        return _pass_b(model_data, features, b, mean, std, has_start, ef["times"], ef["C"], ef["e"])

    ll, ef, stats = evaluate(beta)
    step, it, converged = 1.0, 0, False
    for it in range(1, max_steps + 1):
        h2 = second_term(beta, ef, stats)
        grad = ef["grad"] - penalizer * n * beta
        hess = -(h2 - ef["h1"]) - penalizer * n * np.eye(d)
        delta = np.linalg.solve(-hess, grad)
        while True:
            cand = beta + step * delta
            new_ll, new_ef, new_stats = evaluate(cand)
            if new_ll >= ll - 1e-12 * abs(ll) or step < 1e-4:
                break
            step *= 0.5
        beta, ll, ef, stats = cand, new_ll, new_ef, new_stats
        step = min(1.0, step * 2)
        if np.linalg.norm(step * delta) < precision or np.linalg.norm(delta) < precision:
            converged = True
            break
    h2 = second_term(beta, ef, stats)
    hess = -(h2 - ef["h1"]) - penalizer * n * np.eye(d)
    var_norm = np.linalg.inv(-hess)
    coef = beta / std
    variance = var_norm / np.outer(std, std)
    model = CoxModel(list(features), coef, variance, mean, ll, it, n, converged=converged)
    if baseline:
        model.baseline = _breslow(stats)
    return model


def _breslow(stats: dict) -> pd.DataFrame:
    """Breslow baseline hazard at every distinct stop time (partial hazards
    centred at the feature means)."""
    times = stats["stop"].time
    r0, _ = risk_sums(stats, times)
    h = np.where(r0 > 0, stats["stop"].d / np.where(r0 > 0, r0, 1.0), 0.0)
    return pd.DataFrame({"time": times, "baseline_hazard": h, "baseline_cumulative_hazard": np.cumsum(h)})


def risk_set_sums(
    data: DataFrame, coefficients: dict[str, float], stop_col: str, event_col: str, start_col: str | None = None
) -> DataFrame:
    """The fit's own risk-set sums at given coefficients: per distinct event
    time the events, S0 = Σ exp(x·β) and per feature S1 = Σ x·exp(x·β) over
    the rows at risk (features as they are).  One row per event time."""
    names = list(coefficients)
    cols = [F.col(c).cast("double").alias(c) for c in names]
    cols += [F.col(stop_col).cast("double").alias("stop"), F.col(event_col).cast("double").alias("event")]
    if start_col:
        cols.append(F.col(start_col).cast("double").alias("start"))
    d = len(names)
    stats = _pass_a(data.select(*cols), names, np.array(list(coefficients.values()), dtype=float), np.zeros(d), np.ones(d), start_col is not None)
    stop = stats["stop"]
    has = stop.d > 0
    s0, s1 = risk_sums(stats, stop.time[has])
    rows = [
        (float(t), int(n), float(z), *map(float, v)) for t, n, z, v in zip(stop.time[has], stop.d[has], s0, s1)
    ]
    kinds = ", ".join(["time double", "n_events long", "s0 double", *[f"s1_{c} double" for c in names]])
    return data.sparkSession.createDataFrame(rows, kinds)


def partial_hazard(df: DataFrame, model: CoxModel, out_col: str = "partial_hazard") -> DataFrame:
    """exp((x - x̄)·β) as a column expression."""
    eta = sum(
        ((F.col(c).cast("double") - F.lit(float(m))) * F.lit(float(b)) for c, m, b in zip(model.features, model.norm_mean, model.coefficients)),
        F.lit(0.0),
    )
    return df.withColumn(out_col, F.exp(eta))


def baseline_cumulative_hazard_at(model: CoxModel, t: float) -> float:
    """H0(t), linearly interpolated between the distinct observed times and
    constant beyond both ends (the reference's library interpolates the
    same way when asked for arbitrary times)."""
    base = model.baseline
    if base is None or base.empty:
        return 0.0
    return float(np.interp(t, base["time"].to_numpy(float), base["baseline_cumulative_hazard"].to_numpy(float)))


def survival_at(df: DataFrame, model: CoxModel, months, hazard_col: str = "partial_hazard") -> DataFrame:
    """S(t|x) = exp(-H0(t)·hazard) at each requested month; H0 comes from the
    baseline table (one row per distinct time, model-sized)."""
    out = df
    for t in months:
        h0 = baseline_cumulative_hazard_at(model, t)
        out = out.withColumn(f"survival_prob_{t}m", F.exp(-F.lit(h0) * F.col(hazard_col)))
    return out
