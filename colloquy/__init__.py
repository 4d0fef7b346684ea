"""Discussion analytics on Spark: comments in, reports and classifiers out."""

__version__ = "0.1.0"
