"""Credit-risk features, scoring metrics and drift detection as Spark DataFrame operators."""

__version__ = "0.1.0"
