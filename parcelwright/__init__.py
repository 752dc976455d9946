"""PySpark-native analytics for public-record property signals."""
