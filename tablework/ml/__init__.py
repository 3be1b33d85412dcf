"""Splits, preprocessing, models, metrics and model bundles."""
