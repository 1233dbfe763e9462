"""visitflow.operators."""
