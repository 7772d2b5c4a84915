"""Queries over the driver tables registered in __spark_entry__ (Spark side and oracle SQL)."""
