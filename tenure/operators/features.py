"""Feature selection and scaling with population statistics.

sklearn's VarianceThreshold and StandardScaler use population moments
(ddof 0); MLlib's VarianceThresholdSelector / StandardScaler use sample
moments, so both are expressed directly as one ``agg`` over the columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureSelection:
    kept_columns: list[str]
    dropped_columns: list[str]


@dataclass(frozen=True)
class Scaler:
    """Per-feature mean and scale (population std; 1.0 for constant columns)."""

    columns: list[str]
    means: list[float]
    scales: list[float]

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            list(zip(self.columns, self.means, self.scales)), "feature string, mean double, scale double"
        )


def feature_columns(columns, exclude) -> list[str]:
    ex = set(exclude)
    return [c for c in columns if c not in ex]


def variances(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: population variance of each column over its non-null values
    (an all-null column has no variance and is dropped)."""
    return df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in columns])


def variance_filter(df: DataFrame, columns: list[str], threshold: float) -> FeatureSelection:
    """Keep columns whose population variance is strictly above ``threshold``."""
    if not columns:
        raise ValueError("variance filter: no columns given")
    if df.limit(1).count() == 0:
        raise ValueError("variance filter: no rows given")
    row = variances(df, columns).first()
    kept = [c for c in columns if row[c] is not None and row[c] > threshold]
    if not kept:
        raise ValueError(f"variance filter: no column varies by more than {threshold}")
    return FeatureSelection(kept, [c for c in columns if c not in kept])


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    exprs = []
    for i, c in enumerate(columns):
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        exprs += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    row = df.agg(*exprs).first()
    means = [float(row[f"m{i}"] or 0.0) for i in range(len(columns))]
    scales = []
    for i in range(len(columns)):
        scales.append(_scale(float(row[f"s{i}"] or 0.0), means[i]))
    return Scaler(list(columns), means, scales)


def filter_and_scale(df: DataFrame, columns: list[str], threshold: float) -> tuple[FeatureSelection, Scaler]:
    """``variance_filter`` and ``fit_scaler`` of the kept columns, in one pass where these have no null."""
    if not columns:
        raise ValueError("variance filter: no columns given")
    exprs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        exprs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    row = df.agg(*exprs).first()
    if not row["n"]:
        raise ValueError("variance filter: no rows given")
    kept = [i for i in range(len(columns)) if row[f"v{i}"] is not None and row[f"v{i}"] > threshold]
    if not kept:
        raise ValueError(f"variance filter: no column varies by more than {threshold}")
    names = [columns[i] for i in kept]
    selection = FeatureSelection(names, [c for c in columns if c not in names])
    if any(row[f"n{i}"] < row["n"] for i in kept):
        return selection, fit_scaler(df, names)
    means = [float(row[f"m{i}"]) for i in kept]
    return selection, Scaler(names, means, [_scale(math.sqrt(row[f"v{i}"]), m) for i, m in zip(kept, means)])


def _scale(deviation: float, mean: float) -> float:
    """The deviation, or 1 where it is only rounding."""
    return deviation if deviation > 10 * 2.220446049250313e-16 * max(1.0, abs(mean)) else 1.0


def standardize(df: DataFrame, scaler: Scaler, keep=()) -> DataFrame:
    """Impute 0, subtract mean, divide by scale; other columns in ``keep`` pass through."""
    scaled = [
        ((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m)) / F.lit(s)).alias(c)
        for c, m, s in zip(scaler.columns, scaler.means, scaler.scales)
    ]
    return df.select(*[F.col(k) for k in keep], *scaled)
