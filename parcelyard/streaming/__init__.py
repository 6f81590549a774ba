"""Continuing delivery of arriving data."""
