"""Folders that files keep arriving in."""
