"""Whole jobs, and the catalogue of checked queries."""
