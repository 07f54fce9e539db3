"""Batch feature mart and scoring library on the PySpark DataFrame API."""
