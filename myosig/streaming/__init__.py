"""myosig.streaming."""
