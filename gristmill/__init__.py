"""gristmill: a PySpark-native retrieval, curation and evaluation engine."""

__version__ = "0.1.0"
