"""Row index and window operators against direct (pandas / numpy) computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from myosig.functions import features as ft
from myosig.operators.index import with_lags, with_row_index
from myosig.operators.windows import sliding_windows, tumbling_windows


def _series(spark, sizes, seed=0, parts=7):
    rng = np.random.default_rng(seed)
    rows = []
    for s, n in enumerate(sizes):
        for i in range(n):
            rows.append((s, i, float(rng.normal()), f"a{(i // 13) % 3}"))
    pdf = pd.DataFrame(rows, columns=["series", "t", "x", "act"]).sample(frac=1.0, random_state=seed)
    return spark.createDataFrame(pdf).repartition(parts), pdf


def test_row_index_global_and_segmented(spark):
    # one hot series holding most rows, plus many small ones
    df, pdf = _series(spark, [3000, 5, 17, 1, 40, 250])
    g = with_row_index(df, ["series", "t"], count_name="n").toPandas().sort_values(["series", "t"])
    assert g["idx"].tolist() == list(range(len(pdf)))
    assert (g["n"] == len(pdf)).all()
    s = with_row_index(df, ["t"], series=["series"], count_name="n").toPandas().sort_values(["series", "t"])
    assert (s["idx"] == s["t"]).all()
    assert (s["n"] == s.groupby("series")["t"].transform("size")).all()


def _direct_windows(x, size, step, inclusive=True):
    n = len(x)
    last = n - size if inclusive else n - size - 1
    out = []
    for k, s in enumerate(range(0, last + 1, step)):
        w = x[s : s + size]
        d = np.diff(w)
        out.append((k, np.mean(np.abs(w)), np.abs(d).sum(), int((w[1:] * w[:-1] < 0).sum()), int((d[1:] * d[:-1] < 0).sum())))
    return out


@pytest.mark.parametrize("size,step,inclusive", [(8, 4, True), (7, 3, False), (307, 153, True), (10, 10, True), (5, 1, True)])
def test_sliding_matches_direct(spark, size, step, inclusive):
    df, pdf = _series(spark, [1200], seed=size)
    ix = with_row_index(df, ["t"], count_name="n_rows")
    ix = with_lags(ix, ["x"], lags=2, block=64)  # small blocks: exercises the halo rows
    w = sliding_windows(
        ix, size, step, inclusive_end=inclusive,
        aggs={"mav": ft.mav("x"), "wl": ft.waveform_length("x"), "zc": ft.zero_crossings("x"), "ssc": ft.slope_sign_changes("x")},
    ).toPandas().sort_values("window_id")
    x = pdf.sort_values("t")["x"].to_numpy()
    exp = _direct_windows(x, size, step, inclusive)
    assert len(w) == len(exp) == (len(x) - size - (0 if inclusive else 1)) // step + 1
    for (k, mav, wl, zc, ssc), row in zip(exp, w.itertuples()):
        assert row.window_id == k
        assert row.mav == pytest.approx(mav, rel=1e-12)
        assert row.wl == pytest.approx(wl, rel=1e-12)
        assert row.zc == zc and row.ssc == ssc


@pytest.mark.parametrize("n,inclusive,expected", [(5, True, 0), (8, True, 1), (8, False, 0), (11, True, 1), (12, True, 2)])
def test_window_edges(spark, n, inclusive, expected):
    df = spark.createDataFrame([(i, float(i)) for i in range(n)], "t long, x double")
    ix = with_row_index(df, ["t"], count_name="n_rows")
    w = sliding_windows(ix, 8, 4, inclusive_end=inclusive, aggs={"m": ft.mean("x")})
    assert w.count() == expected


def test_purity_and_labels(spark):
    # two activities; windows crossing the boundary are dropped; majority tie -> smallest label
    rows = [(i, "b" if i < 6 else "a", float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "t long, act string, x double")
    ix = with_row_index(df, ["t"], count_name="n_rows")
    w = sliding_windows(ix, 4, 2, purity=["act"], labels={"last": ("act", "last")}).toPandas()
    assert sorted(w["window_id"]) == [0, 1, 3, 4]
    m = sliding_windows(ix, 4, 2, labels={"maj": ("act", "majority")}).toPandas().set_index("window_id")
    assert m.loc[2, "maj"] == "a"  # rows 4,5 = b, 6,7 = a: tie -> 'a'


def test_zero_sample_never_crosses(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 0.0, -1.0, 0.0, 1.0, -1.0])], "t long, x double")
    ix = with_lags(with_row_index(df, ["t"], count_name="n_rows"), ["x"], lags=1)
    w = sliding_windows(ix, 6, 6, aggs={"zc": ft.zero_crossings("x")}).first()
    assert w["zc"] == 1


def test_tumbling_drops_tail(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "t long, x double")
    ix = with_row_index(df, ["t"])
    t = tumbling_windows(ix, 4, aggs={"s": F.sum("x")}).toPandas().sort_values("chunk")
    assert t["s"].tolist() == [6.0, 22.0]


@pytest.mark.parametrize("series", [[], ["series"]])
def test_index_time_lags_match_block_lags(spark, series):
    df, pdf = _series(spark, [900, 3, 1, 40, 260], seed=11, parts=5)
    df = df.withColumn("x", F.when(F.col("t") == 7, F.lit(float("nan"))).otherwise(F.col("x")))
    order = ["t"] if series else ["series", "t"]
    a = with_row_index(df, order, series=series, lag_cols=["x"], lags=2, num_partitions=13).toPandas()
    b = with_lags(with_row_index(df, order, series=series), ["x"], series=series, lags=2, block=50).toPandas()
    keys = ["series", "t"]
    a, b = a.sort_values(keys).reset_index(drop=True), b.sort_values(keys).reset_index(drop=True)
    for c in ["x_lag1", "x_lag2"]:
        assert (a[c].isna() == b[c].isna()).all()
        np.testing.assert_allclose(a[c].fillna(-1).to_numpy(dtype=float), b[c].fillna(-1).to_numpy(dtype=float))
