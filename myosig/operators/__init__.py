"""myosig.operators."""
