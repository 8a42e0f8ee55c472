"""lakemart: a PySpark-native retail warehouse and analytics library."""
