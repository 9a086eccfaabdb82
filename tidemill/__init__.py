"""A PySpark-native engine for managing time-partitioned data."""
