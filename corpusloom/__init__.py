"""Spark-native preparation of a text corpus: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
