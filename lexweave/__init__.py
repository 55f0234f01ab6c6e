"""lexweave: a PySpark-native engine for merging, cleaning and querying multilingual lexical graphs."""

__version__ = "0.1.0"
