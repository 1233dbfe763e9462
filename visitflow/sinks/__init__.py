"""visitflow.sinks."""
