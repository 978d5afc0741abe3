"""A PySpark-native engine for provenance-tracked financial facts and corpus preparation."""
