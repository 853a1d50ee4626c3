"""refloom: a PySpark-native engine for citation-reference analytics."""
