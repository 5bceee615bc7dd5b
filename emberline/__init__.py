"""Spark-native analytics over thermal detections, and operators for training data."""
