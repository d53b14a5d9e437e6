"""myosig: Spark-native windowing, features, models and control for multi-channel sensor recordings."""

__version__ = "0.1.0"
