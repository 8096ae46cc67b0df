"""Composed jobs: the entry points a user calls."""
