"""Schemas, scans, sinks and the view registry."""
