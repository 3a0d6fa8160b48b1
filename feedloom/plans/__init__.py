"""Whole feeds: rows, loads and runs."""
