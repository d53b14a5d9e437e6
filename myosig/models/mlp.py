"""ML-13: a one-hidden-layer MLP regressor trained by local mini-batch steps between merges.

One Spark job is a round: every task starts from the same weights, makes ``per_round`` passes over
its own rows in mini-batches with Adam, and returns weights and Adam moments times its number of
rows; their mean starts the next round (local SGD: Stich, ICLR 2019).  What a task returns has the
size of the model, is added in two steps where there are many tasks, and a round costs as many
bytes whatever the number of rows.

Rows are dealt to tasks in turn, so that every task sees as many of each recording although these are
stored one after the other, and equal rows do not meet in one task; there they are sorted by value, so
a task that is run again repeats its steps.

The same round also measures the weights it starts from on the rows marked in ``val_col``
(without it: on the training rows).  If that loss has not improved by ``tol`` for ``patience``
passes the learning rate is halved and training goes on from the best weights; after ``halvings`` of
them it ends.  The best weights measured are the result.

Rows with a null or NaN in a feature or target are left out; without training rows the weights
stay as they were drawn.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.models.stacked import collected

#: Rows that a task holds and trains on, in bytes.
PARTITION_BYTES = 16 << 20
_MIX = 0x9E3779B97F4A7C15


class _Net:
    """Weights as one vector: hidden x d, hidden, t x hidden, t."""

    def __init__(self, d: int, hidden: int, t: int):
        self.shapes = [(hidden, d), (hidden,), (t, hidden), (t,)]
        self.cuts = np.cumsum([math.prod(s) for s in self.shapes])
        self.size = int(self.cuts[-1])

    def open(self, w: np.ndarray) -> list[np.ndarray]:
        return [p.reshape(s) for p, s in zip(np.split(w, self.cuts[:-1]), self.shapes)]

    def drawn(self, rng: np.random.Generator) -> np.ndarray:
        w = np.zeros(self.size)
        parts = self.open(w)
        for p in (parts[0], parts[2]):
            p[...] = rng.normal(0, math.sqrt(2.0 / p.shape[1]), p.shape)
        return w

    def loss(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
        w1, b1, w2, b2 = self.open(w)
        return float(((np.maximum(x @ w1.T + b1, 0.0) @ w2.T + b2 - y) ** 2).sum())

    def gradient(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of the mean squared error, summed over targets."""
        w1, b1, w2, b2 = self.open(w)
        h = np.maximum(x @ w1.T + b1, 0.0)
        e = 2.0 * (h @ w2.T + b2 - y) / len(x)
        back = (e @ w2) * (h > 0)
        return np.concatenate([(back.T @ x).ravel(), back.sum(0), (e.T @ h).ravel(), e.sum(0)])


def _passes(net: _Net, state: np.ndarray, steps: int, x: np.ndarray, y: np.ndarray, passes: int, batch: int, lr: float, rng: np.random.Generator) -> np.ndarray:
    """Adam on mini-batches; ``state`` is weights, first and second moments."""
    w, m, v = (p.copy() for p in np.split(state, 3))
    for _ in range(passes):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            some = order[i : i + batch]
            g = net.gradient(w, x[some], y[some])
            steps += 1
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= lr * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    return np.concatenate([w, m, v])


def fit_mlp_regressor(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    hidden: int = 30,
    epochs: int = 500,
    lr: float = 1e-2,
    seed: int = 0,
    val_col: str | None = None,
    patience: int = 40,
    tol: float = 1e-4,
    per_round: int = 20,
    batch: int = 50,
    halvings: int = 3,
    partition_bytes: int = PARTITION_BYTES,
) -> dict:
    """Fit on at most ``epochs`` passes; ``tol`` is relative to the best loss.

    Returns ``layers`` [(W, b), (W, b)] with W[out][in], and ``history``: (passes, training loss, loss measured)
    of every round, losses being mean squared errors per target.
    """
    d, t = len(features), len(targets)
    net, rng = _Net(d, hidden, t), np.random.default_rng(seed)
    val = F.coalesce(F.col(val_col).cast("boolean"), F.lit(False)) if val_col else F.lit(False)
    names = [f"_c{i}" for i in range(d + t)]
    rows = df.select(*[F.col(c).cast("double").alias(a) for c, a in zip([*features, *targets], names)], val.alias("_val")).dropna()
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    tasks = max(1, math.ceil(rows.count() * 8 * (d + t + 2) / partition_bytes))
    data = rows.repartition(tasks).sortWithinPartitions(*names, "_val").persist(StorageLevel.MEMORY_AND_DISK)

    def round_of(state: np.ndarray, steps: int, passes: int, rate: float, number: int):
        sent = df.sparkSession.sparkContext.broadcast(state)

        def run(batches):
            parts = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1).astype(float) for b in batches if b.num_rows]
            if not parts:
                return
            table, state = np.concatenate(parts), sent.value
            kept, marked = table[table[:, -1] == 0], table[table[:, -1] == 1]
            x, y = kept[:, :d], kept[:, d : d + t]
            start = state[: net.size]
            sums = [net.loss(start, x, y), len(x), net.loss(start, marked[:, :d], marked[:, d : d + t]), len(marked)]
            order = np.random.default_rng([seed, number, TaskContext.get().partitionId()])
            after = _passes(net, state, steps, x, y, passes, batch, rate, order) if len(x) else state
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([after * len(x), sums]).tobytes()], pa.binary())], names=["v"])

        total = collected(data.mapInArrow(run, "v binary"), tasks)
        sent.destroy()
        return total

    state = np.concatenate([net.drawn(rng), np.zeros(2 * net.size)])
    best, kept, kept_steps, wait, cut, done, steps, history = math.inf, state, 0, 0, 0, 0, 0, []
    while True:
        passes = min(per_round, epochs - done)
        total = round_of(state, steps, passes, lr * 0.5**cut, len(history))
        if not len(total):
            break
        loss, n, vloss, vn = total[-4:]
        measured = (vloss / vn if vn else loss / max(n, 1)) / t
        history.append((done, loss / max(n, 1) / t, measured))
        if measured < best:
            wait = 0 if measured < best * (1 - tol) else wait + per_round
            best, kept, kept_steps = measured, state, steps
        elif state is not kept:  # the best weights start again after a halving
            wait += per_round
        if not n or not passes:
            break
        if wait >= patience:
            if cut == halvings:
                break
            cut, wait, state, steps = cut + 1, 0, kept, kept_steps
            continue
        state, done = total[:-4] / n, done + passes
        steps += passes * math.ceil(n / tasks / batch)
    data.unpersist()
    rows.unpersist()
    w1, b1, w2, b2 = net.open(kept[: net.size])
    return {"layers": [(w1.tolist(), b1.tolist()), (w2.tolist(), b2.tolist())], "history": history}
