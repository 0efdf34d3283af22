"""Sales-mart toolkit: DataFrame-to-DataFrame building blocks on Spark built-ins."""

__version__ = "0.1.0"
