"""Continuous apply of a landed change feed."""
