"""visitflow: a Spark-native patient-visit pipeline (bronze -> silver -> gold -> KPIs)."""

__version__ = "0.1.0"
