"""Scans and sinks; every scan returns its rejects as rows."""
