"""Incremental runs driven by a file stream."""
