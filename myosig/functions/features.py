"""AGG-01..17: time-domain window features as Spark aggregate expressions.

Every expression is algebraic (sums, counts, min/max, max_by) so Spark can run
it as a partial aggregate before the shuffle.  Difference features read the
``<c>_lag1`` / ``<c>_lag2`` columns made by :func:`myosig.operators.index.with_lags`
and the in-window offset ``_rel``: the first row of a window has no in-window
predecessor, so its difference is ignored (as ``np.diff`` over the window does).

NaN follows numpy (propagates through sums and means); NULL is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from myosig.operators.windows import REL


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _name(c: str | Column) -> str:
    if not isinstance(c, str):
        raise TypeError("difference features need a column name (to find its lag columns)")
    return c


def mav(c) -> Column:
    """AGG-01/02: mean absolute value (for a per-row channel mean of |x|, the mean over rows)."""
    return F.avg(F.abs(_c(c)))


def mean(c) -> Column:
    """AGG-03."""
    return F.avg(_c(c))


def std_pop(c) -> Column:
    """AGG-04: population standard deviation (np.std)."""
    return F.stddev_pop(_c(c))


def rms(c) -> Column:
    """AGG-05."""
    x = _c(c)
    return F.sqrt(F.avg(x * x))


def energy(c) -> Column:
    """AGG-06: sum of squares."""
    x = _c(c)
    return F.sum(x * x)


def diff1(c: str) -> Column:
    return F.col(c) - F.col(f"{c}_lag1")


def diff_prev(c: str) -> Column:
    return F.col(f"{c}_lag1") - F.col(f"{c}_lag2")


def waveform_length(c) -> Column:
    """AGG-07: sum of |x_i - x_{i-1}| inside the window."""
    c = _name(c)
    return F.coalesce(F.sum(F.when(F.col(REL) >= 1, F.abs(diff1(c)))), F.lit(0.0))


def zero_crossings(c) -> Column:
    """AGG-08: count of x_i * x_{i-1} < 0 (a zero sample never counts)."""
    c = _name(c)
    return F.count_if((F.col(REL) >= 1) & (F.col(c) * F.col(f"{c}_lag1") < 0)).cast("bigint")


def slope_sign_changes(c) -> Column:
    """AGG-09: count of d_i * d_{i-1} < 0, with d the first difference."""
    c = _name(c)
    return F.count_if((F.col(REL) >= 2) & (diff1(c) * diff_prev(c) < 0)).cast("bigint")


def jerk_std(c) -> Column:
    """AGG-10: population std of the W-1 first differences."""
    c = _name(c)
    return F.stddev_pop(F.when(F.col(REL) >= 1, diff1(c)))


def peak_to_peak(c) -> Column:
    """AGG-11."""
    return F.max(_c(c)) - F.min(_c(c))


def last_value(c, idx: str = "idx") -> Column:
    """AGG-12/15: value at the window's last sample."""
    return F.max_by(_c(c), F.col(idx))


def majority(c) -> Column:
    """AGG-13/14: most frequent non-null value; a tie goes to the smallest value."""
    return F.mode(_c(c), deterministic=True)


def target_mean(c) -> Column:
    """AGG-16."""
    return F.avg(_c(c))


def row_abs_mean(arr) -> Column:
    """Per-row mean over channels of |x| (reduces an electrode grid to one scalar before windowing)."""
    a = _c(arr)
    return F.aggregate(F.transform(a, lambda v: F.abs(v).cast("double")), F.lit(0.0), lambda s, v: s + v) / F.size(a)


def row_mean(arr) -> Column:
    a = _c(arr)
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double")) / F.size(a)
