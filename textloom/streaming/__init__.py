"""Incremental jobs: run until caught up, then stop."""
