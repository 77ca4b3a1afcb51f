"""Readers, versioned tables and generated snapshots."""
