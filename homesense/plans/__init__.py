"""Composite plans: domain recipes and the registered driver-table queries."""
