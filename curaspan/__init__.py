"""curaspan: curate free text for model training as plain Spark DataFrame jobs."""

__version__ = "0.1.0"
