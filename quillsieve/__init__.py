"""A PySpark-native engine for landing, conforming and checking claims data."""
