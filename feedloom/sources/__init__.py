"""Scans: each returns a lazy DataFrame."""
