"""corpusflow: a PySpark-native engine that builds and audits dialogue corpora."""

__version__ = "0.1.0"
