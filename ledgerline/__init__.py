"""Ledgerline: officiating analytics as lazy PySpark plans."""
