"""Registered queries: each pairs a Spark plan with an independent SQL oracle."""

from myosig.plans.registry import REGISTRY, Query  # noqa: F401
from myosig.plans import q_windows, q_cleaning, q_sequence, q_splits, q_models, q_eval, q_stream, q_fit, q_more, q_store, q_sketch  # noqa: F401


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)
