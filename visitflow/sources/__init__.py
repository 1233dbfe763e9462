"""visitflow.sources."""
