"""Lakehouse pipelines written as plain PySpark functions."""
