"""Whole jobs: stored tables and landed files in, stored tables out."""
