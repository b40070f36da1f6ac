"""Spark-native processing of recorded multi-topic sensor streams, frame datasets and training text."""
