"""Readers for job manifests, catalogs and staging tables."""
