"""PySpark-native engine for annotated-literature analytics."""
