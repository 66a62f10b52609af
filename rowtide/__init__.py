"""Change-data-capture tables on Spark: decode a byte feed, apply it, read it back."""

__version__ = "0.1.0"
