"""Per-key state, sinks and runs of streaming queries."""
