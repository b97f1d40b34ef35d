"""A PySpark-native engine for point-level vegetation-index time series."""
