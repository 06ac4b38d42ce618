"""Scans, sinks and the test-data adapters."""
