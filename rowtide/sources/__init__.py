"""Readers for landed change feeds and delimited files."""
