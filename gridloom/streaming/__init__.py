"""Incremental refresh of stored facts."""
