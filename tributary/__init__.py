"""Spark-native change capture, segmentation, relational, search and pipeline operators."""
