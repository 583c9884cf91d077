"""Column functions: patterns and string helpers."""
