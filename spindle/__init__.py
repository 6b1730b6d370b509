"""spindle: a PySpark-native engine for curating code-edit training data."""

__version__ = "0.1.0"
