"""Whole plans: the stored trade table, and the registered queries."""
