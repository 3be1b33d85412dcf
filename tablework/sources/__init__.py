"""Readers, writers and table generators."""
