"""Sievework: source-preserving text feeds as Spark DataFrame pipelines."""
