"""Batch data delivery on Spark: extract, split, validate, deliver, audit, reconcile."""
