"""Readers of landed data."""
