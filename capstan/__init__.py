"""Caption preparation, scoring and generation as Spark DataFrame jobs."""

__version__ = "0.1.0"
