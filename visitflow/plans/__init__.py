"""visitflow.plans."""
