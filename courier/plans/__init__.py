"""Whole plans: queue cycles and the registered queries."""
