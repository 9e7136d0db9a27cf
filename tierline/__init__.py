"""Layered (bronze, silver, gold) analytics on PySpark."""
