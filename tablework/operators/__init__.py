"""Relational, cleaning, ordering, statistics, matrix and chart-data operators."""
