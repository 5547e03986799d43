"""Registered query plans."""
