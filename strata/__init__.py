"""Layered tables on PySpark: land, type, clean, merge, aggregate and reconcile."""
