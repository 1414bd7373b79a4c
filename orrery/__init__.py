"""A PySpark-native analytics engine for operational incident knowledge."""
