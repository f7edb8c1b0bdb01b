"""L2 logistic regression (MLlib) with sklearn-equivalent regularisation,
closed-form scoring from the coefficient table, coefficient summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.operators.features import Scaler


@dataclass(frozen=True)
class LogisticModel:
    """Fitted model in original feature units: p = sigmoid(b + Σ w_j (x_j - m_j)/s_j)."""

    scaler: Scaler
    coefficients: list[float]
    intercept: float
    n_train: int

    def coefficient_frame(self, spark) -> DataFrame:
        rows = list(zip(self.scaler.columns, self.coefficients))
        return coef_rank(spark.createDataFrame(rows, "feature string, coefficient double"), "coefficient")


def fit_logistic(train_scaled: DataFrame, label: str, scaler: Scaler, c: float = 1.0, max_iter: int = 5000) -> LogisticModel:
    """Minimise ½‖w‖² + C·Σ log-loss (intercept unpenalised) on standardized
    features.  MLlib minimises mean loss + λ/2‖w‖², hence λ = 1/(C·n)."""
    n = train_scaled.count()
    assembled = VectorAssembler(inputCols=scaler.columns, outputCol="features").transform(train_scaled)
    lr = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        maxIter=max_iter,
        tol=1e-10,
    )
    model = lr.fit(assembled.select("features", F.col(label).cast("double").alias(label)))
    return LogisticModel(scaler, [float(x) for x in model.coefficients.toArray()], float(model.intercept), n)


def linear_score(model: LogisticModel) -> F.Column:
    terms = [
        ((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m)) / F.lit(s)) * F.lit(w)
        for c, m, s, w in zip(model.scaler.columns, model.scaler.means, model.scaler.scales, model.coefficients)
    ]
    return sum(terms, F.lit(model.intercept))


def predict_logistic(df: DataFrame, model: LogisticModel, prob_col: str = "probability", label_col: str = "predicted_label") -> DataFrame:
    """P(class 1) and the 0/1 prediction (P > 0.5) as column expressions:
    N rows in, N rows out, no Python per row."""
    z = linear_score(model)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.withColumn(prob_col, p).withColumn(label_col, (F.col(prob_col) > 0.5).cast("int"))


def coef_rank(coefs: DataFrame, coef_col: str = "coefficient") -> DataFrame:
    """Add ``abs_coefficient`` and order by it (desc), ties by feature."""
    return coefs.withColumn("abs_" + coef_col, F.abs(F.col(coef_col))).orderBy(F.desc("abs_" + coef_col), "feature")


def top_positive_negative(coefs: DataFrame, coef_col: str, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Top-n by coefficient (desc) and bottom-n re-sorted ascending."""
    top = coefs.orderBy(F.desc(coef_col), "feature").limit(n)
    bottom = coefs.orderBy(F.asc(coef_col), "feature").limit(n)
    return top, bottom
