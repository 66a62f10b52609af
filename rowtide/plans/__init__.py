"""Stored tables, multi-table jobs and the registered queries."""
