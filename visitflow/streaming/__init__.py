"""visitflow.streaming."""
