"""A PySpark-native engine for building, repairing and querying knowledge graphs."""
