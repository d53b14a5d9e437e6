"""ML-01/05/11/21/22: closed-form linear models and array-expression scorers.

Fitting is two distributed passes (means, then centred cross products, one
matrix product per Arrow batch -- numerically safer than raw sums); the d x d solve happens on the
driver, where the input is O(d^2) numbers whatever the row count.  Scoring is a
per-row expression (JVM, whole-stage codegen), so it scales with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from myosig.functions import broadcast_if_small


def _gram(df: DataFrame, left: Sequence[str], right: Sequence[str], centre: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], extra: Sequence[str] = ()) -> np.ndarray:
    """sum over rows of a^T b with (a, b) = ``centre(batch)``: a matrix product per Arrow batch,
    one matrix per task, and the tasks' matrices summed entry by entry in a shuffle of d x d keys."""
    cols = list(dict.fromkeys([*left, *right]))
    shape = (len(left), len(right))

    def run(batches):
        g = np.zeros(shape)
        for b in batches:
            x, y = centre(b)
            g += x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([g.ravel()], pa.list_(pa.float64()))], ["g"])

    per_task = df.select(*extra, *[F.col(c).cast("double").alias(c) for c in cols]).mapInArrow(run, "g array<double>")
    rows = per_task.select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(shape[0] * shape[1])
    for r in rows:
        out[r.i] = r.v
    return out.reshape(shape)


def _matrix(batch: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols])


@dataclass
class LinearModel:
    features: list[str]
    targets: list[str]
    intercept: np.ndarray  # (t,)
    coef: np.ndarray  # (t, d)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(t, float(self.intercept[k]), [float(v) for v in self.coef[k]]) for k, t in enumerate(self.targets)]
        return spark.createDataFrame(rows, "target string, intercept double, coef array<double>")

    def predict(self, df: DataFrame, suffix: str = "_pred") -> DataFrame:
        out = df
        for k, t in enumerate(self.targets):
            e = F.lit(float(self.intercept[k]))
            for j, f in enumerate(self.features):
                e = e + F.lit(float(self.coef[k, j])) * F.col(f)
            out = out.withColumn(f"{t}{suffix}", e)
        return out


def fit_ridge(df: DataFrame, features: Sequence[str], targets: Sequence[str], alpha: float = 1.0) -> LinearModel:
    """ML-11: ridge regression, intercept unpenalised (scikit-learn ``Ridge``)."""
    feats, tgts = list(features), list(targets)
    clean = df.dropna(subset=feats + tgts)
    m = clean.agg(*[F.avg(c).alias(c) for c in feats + tgts], F.count(F.lit(1)).alias("_n")).first()
    xm = np.array([m[c] for c in feats], dtype="float64")
    ym = np.array([m[c] for c in tgts], dtype="float64")
    both = np.concatenate([xm, ym])

    def centre(b):
        z = _matrix(b, feats + tgts) - both
        return z[:, : len(feats)], z

    s = _gram(clean, feats, feats + tgts, centre)
    coef = np.linalg.solve(s[:, : len(feats)] + alpha * np.eye(len(feats)), s[:, len(feats) :]).T  # (t, d)
    return LinearModel(feats, tgts, ym - coef @ xm, coef)


@dataclass
class LdaModel:
    features: list[str]
    classes: list
    counts: np.ndarray
    priors: np.ndarray
    means: np.ndarray  # (k, d)
    covariance: np.ndarray  # (d, d)
    coef: np.ndarray  # (k, d)
    intercept: np.ndarray  # (k,)

    def to_frame(self, spark: SparkSession, label_type: str = "string") -> DataFrame:
        rows = [
            (c, int(self.counts[i]), float(self.priors[i]), [float(v) for v in self.means[i]], [float(v) for v in self.coef[i]], float(self.intercept[i]))
            for i, c in enumerate(self.classes)
        ]
        return spark.createDataFrame(
            rows, f"class {label_type}, n bigint, prior double, mean array<double>, coef array<double>, intercept double"
        )

    def scores(self) -> list[Column]:
        out = []
        for i in range(len(self.classes)):
            e = F.lit(float(self.intercept[i]))
            for j, f in enumerate(self.features):
                e = e + F.lit(float(self.coef[i, j])) * F.col(f)
            out.append(e)
        return out


def fit_lda(df: DataFrame, features: Sequence[str], label: str) -> LdaModel:
    """ML-05: linear discriminant analysis with the prior-weighted (biased) class covariance.

    Pass 1: class counts and means (one row per class, on the driver).  Pass 2: the
    pooled within-class scatter, where every task subtracts the mean of the row's class.
    Rows with a missing feature or label are left out.
    """
    feats = list(features)
    df = df.dropna(subset=[*feats, label])
    stats = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m_{c}") for c in feats])
    st = sorted(stats.collect(), key=lambda r: r[label])
    classes = [r[label] for r in st]
    counts = np.array([r["_n"] for r in st], dtype="float64")
    means = np.array([[r[f"_m_{c}"] for c in feats] for r in st], dtype="float64")
    n = counts.sum()
    def centre(b):
        own = pc.index_in(b.column("_class"), pa.array(classes, b.column("_class").type)).to_numpy(zero_copy_only=False)
        z = _matrix(b, feats) - means[own]
        return z, z

    scatter = _gram(df.withColumn("_class", F.col(label)), feats, feats, centre, ["_class"])
    cov = scatter / n
    inv = np.linalg.inv(cov)
    priors = counts / n
    coef = means @ inv
    intercept = -0.5 * np.einsum("kd,kd->k", coef, means) + np.log(priors)
    return LdaModel(feats, classes, counts, priors, means, cov, coef, intercept)


# ---------------------------------------------------------------- ML-21 / ML-22 scoring
def _dot(x: Column, w: Sequence[float]) -> Column:
    """sum_j x[j] * w[j] with array higher-order functions (stays in codegen)."""
    wl = F.array(*[F.lit(float(v)) for v in w])
    return F.aggregate(F.zip_with(x, wl, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def scale_array(x: Column, mean: Sequence[float], scale: Sequence[float]) -> Column:
    """(x - mean) / scale elementwise; a zero scale divides by 1."""
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v) if v else 1.0) for v in scale])
    return F.zip_with(F.zip_with(x, m, lambda a, b: a.cast("double") - b), s, lambda a, b: a / b)


def linear_scores(x: Column, coef: Sequence[Sequence[float]], intercept: Sequence[float]) -> Column:
    """ML-21: per-class affine scores as an array."""
    return F.array(*[_dot(x, w) + F.lit(float(b)) for w, b in zip(coef, intercept)])


def mlp_forward(x: Column, layers: Sequence[tuple[Sequence[Sequence[float]], Sequence[float]]]) -> Column:
    """ML-22: dense layers, ReLU between them, linear output; weights as W[out][in]."""
    h = x
    for li, (w, b) in enumerate(layers):
        units = [_dot(h, row) + F.lit(float(bias)) for row, bias in zip(w, b)]
        if li < len(layers) - 1:
            units = [F.greatest(u, F.lit(0.0)) for u in units]
        h = F.array(*units)
    return h


# ---------------------------------------------------------------- per-group closed form and ML-25
def fit_ridge_by_group(df: DataFrame, group: str, feature: str, target: str, alpha: float = 1.0) -> DataFrame:
    """One-feature ridge fitted separately for every group: pass 1 group means,
    pass 2 centred sums (means joined back); one row per group."""
    m = df.groupBy(group).agg(F.avg(feature).alias("_mx"), F.avg(target).alias("_my"))
    j = df.join(broadcast_if_small(m.withColumnRenamed(group, "_g")), df[group].eqNullSafe(F.col("_g"))).drop("_g")
    xc = F.col(feature) - F.col("_mx")
    g = j.groupBy(group, "_mx", "_my").agg(F.sum(xc * xc).alias("_sxx"), F.sum(xc * (F.col(target) - F.col("_my"))).alias("_sxy"))
    coef = F.col("_sxy") / (F.col("_sxx") + F.lit(alpha))
    return g.select(group, coef.alias("coef"), (F.col("_my") - coef * F.col("_mx")).alias("intercept"))


def activity_then_angle(df: DataFrame, activity_expr: Column, models: DataFrame, group: str, feature: str, out: str = "angle") -> DataFrame:
    """ML-25: classify each row's activity, then apply that activity's regressor.

    ``models`` has one row per activity (a bounded table: broadcast)."""
    d = df.withColumn(group, activity_expr)
    j = d.join(broadcast_if_small(models.withColumnRenamed(group, "_g")), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    return j.withColumn(out, F.col("intercept") + F.col("coef") * F.col(feature)).drop("intercept", "coef")
