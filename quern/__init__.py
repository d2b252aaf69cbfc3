"""A PySpark-native company-intelligence analytics engine."""
