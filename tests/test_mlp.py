"""MLP trained by local steps between merges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from myosig.models import linear, mlp


def _full_batch(x, y, xv, yv, hidden, epochs, lr, seed):
    """Best held-out loss of full-batch Adam, one pass over the rows a step."""
    net = mlp._Net(x.shape[1], hidden, y.shape[1])
    w = net.drawn(np.random.default_rng(seed))
    m = v = np.zeros(net.size)
    best = np.inf
    for step in range(1, epochs + 1):
        best = min(best, net.loss(w, xv, yv) / yv.size)
        g = net.gradient(w, x, y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return best


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    net, x, y = mlp._Net(3, 5, 2), rng.normal(size=(20, 3)), rng.normal(size=(20, 2))
    w = rng.normal(size=net.size)
    g = net.gradient(w, x, y)
    for i in range(net.size):
        e = np.eye(net.size)[i] * 1e-6
        assert abs((net.loss(w + e, x, y) - net.loss(w - e, x, y)) / 2e-6 / 20 - g[i]) < 1e-5


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 4))
    y = np.stack([np.sin(2 * x[:, 0]) + x[:, 1] * x[:, 2], np.abs(x[:, 3]) + x[:, 0]], axis=1) + rng.normal(size=(6000, 2)) * 0.05
    x, y = x[np.argsort(y[:, 0])], y[np.argsort(y[:, 0])]  # stored in an order that tells the target
    pdf = pd.DataFrame(np.hstack([x, y]), columns=["a", "b", "c", "d", "y", "z"]).assign(val=np.arange(6000) % 5 == 0)
    return pdf, spark.createDataFrame(pdf).repartitionByRange(6, "y").cache()


def test_full_batch_loss_with_a_tenth_of_its_jobs(rows):
    """Several tasks on sorted rows reach the held-out loss of 500 full-batch steps in at most 50 rounds."""
    pdf, df = rows
    x, y, val = pdf[list("abcd")].to_numpy(), pdf[["y", "z"]].to_numpy(), pdf.val.to_numpy()
    want = _full_batch(x[~val], y[~val], x[val], y[val], 30, 500, 1e-2, 0)
    net = mlp.fit_mlp_regressor(df, list("abcd"), ["y", "z"], val_col="val", partition_bytes=64 << 10)
    assert len(net["history"]) <= 50
    assert min(h[2] for h in net["history"]) <= want * 1.02
    out = linear.mlp_forward(F.array(*list("abcd")), net["layers"])
    got = df.where("val").select(((F.col("y") - out[0]) ** 2 + (F.col("z") - out[1]) ** 2).alias("e")).agg(F.avg("e")).first()[0] / 2
    assert abs(got - min(h[2] for h in net["history"])) < 1e-9


def test_reruns_agree_and_unusable_rows_are_left_out(spark, rows):
    _, df = rows
    args = (list("abcd"), ["y"])
    a = mlp.fit_mlp_regressor(df, *args, epochs=40, partition_bytes=64 << 10)
    b = mlp.fit_mlp_regressor(df, *args, epochs=40, partition_bytes=64 << 10)
    assert a == b and [h[0] for h in a["history"]] == [0, 20, 40]
    small = spark.createDataFrame([(float(i % 7), float(i % 7) * 2) for i in range(70)], "a double, y double")
    dirty = small.unionByName(spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (1.0, None)], small.schema))
    assert mlp.fit_mlp_regressor(dirty, ["a"], ["y"], epochs=10) == mlp.fit_mlp_regressor(small, ["a"], ["y"], epochs=10)
    none = mlp.fit_mlp_regressor(small.limit(0), ["a"], ["y"], epochs=10)
    assert len(none["layers"]) == 2 and none["history"] == []
