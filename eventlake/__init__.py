"""eventlake: a PySpark-native analytics engine for social event streams."""
