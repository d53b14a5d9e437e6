"""Order-insensitive frame comparison shared by the oracle tests (columns by name, rows sorted)."""

import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(got, exp, tol=2e-6):
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    if gc != ec:
        return False, f"columns {gc} vs {ec}"
    if len(gr) != len(er):
        return False, f"rows {len(gr)} vs {len(er)}"
    for a, b in zip(gr, er):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                if abs(x - y) > tol * max(1.0, abs(y)):
                    return False, f"{a} vs {b}"
            elif x != y:
                return False, f"{a} vs {b}"
    return True, ""
