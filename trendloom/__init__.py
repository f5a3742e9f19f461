"""Emerging-topic analytics over scholarly corpora, written as plain Spark DataFrame operators."""
