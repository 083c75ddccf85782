"""PySpark-native document analytics."""
