"""Layered retail-sales analytics on PySpark: raw workbooks to bronze, silver and gold tables."""
