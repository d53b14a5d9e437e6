"""myosig.models."""
