"""Sessionized user-activity analytics, written as PySpark DataFrame jobs."""
