"""EVL-01..09, AGG-26: regression and classification metrics as aggregates.

Metrics are computed from sufficient statistics (counts, sums of errors,
population variance of the truth) in one aggregate pass, so they are exact and
distributed.  Multi-output scores are uniform averages over targets; RMSE is
the square root of the averaged MSE (not the average of RMSEs).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from myosig.session import ensure_checkpoint_dir

#: A confusion matrix has all pairs of labels; beyond this many it is refused.
MAX_CLASSES = 2000


def long_pairs(df: DataFrame, pairs: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Wide (truth, prediction) columns -> long rows (keep..., target, y, p)."""
    arr = F.array(*[F.struct(F.lit(t).alias("target"), F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p")) for t, (y, p) in pairs.items()])
    return df.select(*keep, F.explode(arr).alias("_t")).select(*keep, "_t.target", "_t.y", "_t.p")


def _r2(n: Column, sse: Column, sst: Column) -> Column:
    """1 - SSE/SST; NULL when n <= 1; a constant truth scores 1 if perfect, else 0."""
    return (
        F.when(n <= 1, F.lit(None).cast("double"))
        .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - sse / sst)
    )


def _target_stats(long: DataFrame, by: Sequence[str]) -> DataFrame:
    e = F.col("y") - F.col("p")
    return long.groupBy(*by, "target").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("sse"),
        F.sum(F.abs(e)).alias("sae"),
        F.max(F.abs(e)).alias("max_err"),
        (F.var_pop("y") * F.count(F.lit(1))).alias("sst"),
    )


def metrics_by_target(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """EVL-03/04: n, R², MSE, RMSE, MAE and worst error per (by..., target)."""
    s = _target_stats(long, by)
    mse = F.col("sse") / F.col("n")
    return s.select(
        *by,
        "target",
        "n",
        _r2(F.col("n"), F.col("sse"), F.col("sst")).alias("r2"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (F.col("sae") / F.col("n")).alias("mae"),
        "max_err",
    )


def regression_metrics(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """EVL-01/02: uniform average over targets of R², MSE, MAE; RMSE = sqrt(mean MSE)."""
    t = metrics_by_target(long, by)
    g = t.groupBy(*by).agg(
        F.max("n").alias("n"), F.avg("r2").alias("r2"), F.avg("mse").alias("mse"), F.avg("mae").alias("mae")
    )
    return g.select(*by, "n", "r2", "mse", F.sqrt("mse").alias("rmse"), "mae")


def metrics_rollup(long: DataFrame, by: str = "activity") -> DataFrame:
    """AGG-26: overall and per-``by`` metrics in one pass (grouping sets (by, target), (target)).

    The overall row has ``by`` NULL; ``is_total`` tells it apart from a NULL key.
    """
    e = F.col("y") - F.col("p")
    s = long.groupingSets(
        [[F.col(by), F.col("target")], [F.col("target")]],
        F.col(by),
        F.col("target"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("sse"),
        F.sum(F.abs(e)).alias("sae"),
        (F.var_pop("y") * F.count(F.lit(1))).alias("sst"),
        F.grouping(by).alias("_g"),
    )
    mse = F.col("sse") / F.col("n")
    t = s.select(by, "target", "_g", "n", _r2(F.col("n"), F.col("sse"), F.col("sst")).alias("r2"), mse.alias("mse"), (F.col("sae") / F.col("n")).alias("mae"))
    g = t.groupBy(by, "_g").agg(F.max("n").alias("n"), F.avg("r2").alias("r2"), F.avg("mse").alias("mse"), F.avg("mae").alias("mae"))
    return g.select(by, (F.col("_g") == 1).alias("is_total"), "n", "r2", "mse", F.sqrt("mse").alias("rmse"), "mae")


# ---------------------------------------------------------------- classification
def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-05."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def pair_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """(truth, pred, n) -- at most classes^2 rows."""
    return df.groupBy(F.col(y).alias("truth"), F.col(p).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-07: every (truth, pred) label pair, zeros included (labels from both columns)."""
    ensure_checkpoint_dir(df.sparkSession)
    counts = pair_counts(df, y, p).checkpoint()  # a few rows, read several times
    labels = sorted(
        {r[0] for r in counts.select("truth").distinct().collect()} | {r[0] for r in counts.select("pred").distinct().collect()},
        key=lambda v: (v is None, v),
    )
    if len(labels) > MAX_CLASSES:
        raise ValueError(f"{len(labels)} labels: a matrix of all pairs is meant for at most {MAX_CLASSES}")
    lit_labels = F.array(*[F.lit(v) for v in labels])
    grid = counts.sparkSession.range(1).select(F.explode(lit_labels).alias("truth")).select(
        "truth", F.explode(lit_labels).alias("pred")
    )
    out = grid.join(counts, ["truth", "pred"], "left").select("truth", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    return out


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-06: per-class precision, recall, F1, support; macro and weighted averages; 0 on empty.

    Built from the (truth, pred) count table, so no row-level work beyond one aggregate.
    """
    pc = pair_counts(df, y, p)
    roles = pc.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").cast("string").alias("cls"), F.col("n").alias("sup"), F.lit(0).cast("bigint").alias("prd"), F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("pred").cast("string").alias("cls"), F.lit(0).cast("bigint").alias("sup"), F.col("n").alias("prd"), F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("r")
    ).select("r.*")
    per = roles.groupBy("cls").agg(F.sum("sup").alias("support"), F.sum("prd").alias("predicted"), F.sum("tp").alias("tp"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select("cls", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    ensure_checkpoint_dir(df.sparkSession)
    per = per.withColumn("f1", f1).checkpoint()  # one row per class, read several times
    tot = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("cls"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
        tot.alias("support"),
    )
    acc = per.agg(
        F.lit("accuracy").alias("cls"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        (F.sum("tp") / tot).alias("f1"),
        tot.alias("support"),
    )
    body = per.select("cls", "precision", "recall", "f1", "support")
    return body.unionByName(macro).unionByName(weighted).unionByName(acc).withColumn("support", F.col("support").cast("bigint"))


def fold_report(df: DataFrame, fold: str, y: str, p: str) -> DataFrame:
    """EVL-08: accuracy per fold plus the mean over folds (fold NULL, ``is_mean`` true)."""
    per = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))
    mean = per.agg(F.lit(None).cast(df.schema[fold].dataType).alias(fold), F.sum("n").alias("n"), F.avg("accuracy").alias("accuracy"))
    return per.withColumn("is_mean", F.lit(False)).unionByName(mean.withColumn("is_mean", F.lit(True)))


def joint_error(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """EVL-09: MAE and worst absolute error per target."""
    e = F.abs(F.col("y") - F.col("p"))
    return long.groupBy(*by, "target").agg(F.avg(e).alias("mae"), F.max(e).alias("max_err"))


def compare_smoothers(df: DataFrame, truth: str, raw: str, smooth: str, idx: str = "idx", series: Sequence[str] = ()) -> DataFrame:
    """EVL-10: R2 and MAE against the truth and jitter (std of successive differences) before and
    after smoothing, with the jitter reduction in percent, per series."""
    from myosig.operators.index import with_lags
    from myosig.operators.sequence import jitter_reduction

    d = with_lags(df, [raw, smooth], idx=idx, series=series, lags=1)
    spread = F.var_pop(truth)

    def r2(p: str) -> Column:
        """Constant truth: 1 if matched exactly, else 0."""
        mse = F.avg((F.col(truth) - F.col(p)) * (F.col(truth) - F.col(p)))
        return F.when(spread > 0, 1 - mse / spread).otherwise(F.when(mse == 0, 1.0).otherwise(0.0))

    g = d.groupBy(*series).agg(
        r2(raw).alias("r2_raw"),
        r2(smooth).alias("r2_kalman"),
        F.avg(F.abs(F.col(raw) - F.col(truth))).alias("mae_raw"),
        F.avg(F.abs(F.col(smooth) - F.col(truth))).alias("mae_kalman"),
        F.stddev_pop(F.col(raw) - F.col(f"{raw}_lag1")).alias("jitter_raw"),
        F.stddev_pop(F.col(smooth) - F.col(f"{smooth}_lag1")).alias("jitter_kalman"),
    )
    return g.withColumn("reduction_pct", jitter_reduction(F.col("jitter_raw"), F.col("jitter_kalman")))
