"""lensmill: a Spark-first engine for scoring, curating and measuring text corpora."""

__version__ = "0.1.0"
