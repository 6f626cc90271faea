"""Spark-native analytics over retail transactions, sensor readings and application logs."""
