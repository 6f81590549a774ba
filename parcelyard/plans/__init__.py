"""Delivery runs, sinks, audit and reports."""
