"""Aircraft position reports on Spark: landing, cleaning, aggregates, serving and models."""

__version__ = "0.1.0"
