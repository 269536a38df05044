"""Continuous refresh from a landing folder."""
