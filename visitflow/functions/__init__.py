"""visitflow.functions."""
