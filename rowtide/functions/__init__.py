"""Column functions: wire bytes, text cells, hex payloads."""
