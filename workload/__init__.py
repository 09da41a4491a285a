"""Queries over the test tables, and the same results written independently in SQL."""
