"""Scholarmart: an academic-search warehouse expressed as PySpark DataFrame jobs."""
