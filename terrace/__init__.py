"""Layered business-warehouse analytics on PySpark: batch operators, streaming operators and jobs."""
