"""Continuous intake of session files."""
