"""Landed files in, zone tables out."""
