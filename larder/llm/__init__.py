"""Operators for building training corpora, each a Spark job."""
