"""myosig.sources."""
