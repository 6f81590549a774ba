"""Registered queries over the given tables, their derived inputs, and their oracle SQL."""
