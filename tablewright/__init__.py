"""Tabular analytics and prediction on Spark: profile, validate, prepare, fit, score."""
