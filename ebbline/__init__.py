"""Data retention on Spark: compile policies, plan windows, archive, purge, report.

Every operator takes DataFrames and returns a DataFrame; only ``plans.jobs`` and
``streaming`` read or write storage.
"""
