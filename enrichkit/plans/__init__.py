"""Composed jobs, run metrics and the registered queries."""
