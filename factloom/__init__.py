"""A PySpark-native engine for cited financial facts."""
