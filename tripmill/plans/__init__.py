"""Batch jobs over stored tables, and the registered queries with their SQL."""
