"""A PySpark-native analytics engine: queries declared on DataFrames and SQL."""
