"""Readers and row generators."""
