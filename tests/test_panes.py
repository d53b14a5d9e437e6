"""Pane-form windows against the row-explode form (two implementations, same results)."""

import numpy as np
import pandas as pd
import pytest

from myosig.functions import features as ft
from myosig.operators.index import with_lags, with_row_index
from myosig.operators.panes import sliding_window_stats
from myosig.operators.windows import sliding_windows


@pytest.mark.parametrize("size,step,inclusive", [(307, 153, True), (410, 102, True), (20, 7, False), (12, 3, True), (9, 9, True)])
def test_panes_match_explode(spark, size, step, inclusive):
    rng = np.random.default_rng(size + step)
    rows = []
    for s, n in [(0, 2500), (1, 700), (2, 30)]:
        acts = np.repeat(["walk", "run", "sts"], n // 3 + 1)[:n]
        for i in range(n):
            rows.append((s, i, float(rng.normal(loc=40.0)), str(acts[i])))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["s", "t", "x", "act"]))
    ix = with_row_index(df, ["t"], series=["s"], count_name="n_rows")
    ix = with_lags(ix, ["x"], series=["s"], lags=2, block=256)
    pane = sliding_window_stats(
        ix, size, step, "x", series=["s"], inclusive_end=inclusive, purity=["act"], last_label="act", lag1="x_lag1", lag2="x_lag2"
    ).toPandas().sort_values(["s", "window_id"]).reset_index(drop=True)
    ref = sliding_windows(
        ix, size, step, series=["s"], inclusive_end=inclusive, purity=["act"], labels={"last_act": ("act", "last")},
        aggs={"mean": ft.mean("x"), "mav": ft.mav("x"), "rms": ft.rms("x"), "std": ft.std_pop("x"), "wl": ft.waveform_length("x"),
              "zc": ft.zero_crossings("x"), "ssc": ft.slope_sign_changes("x"), "p2p": ft.peak_to_peak("x")},
    ).toPandas().sort_values(["s", "window_id"]).reset_index(drop=True)
    assert len(pane) == len(ref) and len(ref) > 0
    assert (pane["window_id"] == ref["window_id"]).all()
    assert (pane["n"] == size).all()
    for c in ["mean", "mav", "rms", "wl", "p2p"]:
        np.testing.assert_allclose(pane[c], ref[c], rtol=1e-9)
    np.testing.assert_allclose(pane["std"], ref["std"], rtol=1e-6)
    assert (pane["zc"] == ref["zc"]).all() and (pane["ssc"] == ref["ssc"]).all()
    assert (pane["last_act"] == ref["last_act"]).all()
