"""Whole runs over a folder of tables."""
