"""Tierstone: layered (bronze, silver, gold) analytics as PySpark DataFrame functions."""
