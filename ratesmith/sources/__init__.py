"""Scans, sinks, schemas and the fixture views."""
