"""Scoring of streams: the batch operators on a streaming table."""
