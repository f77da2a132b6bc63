"""Whole flows: cleaning, loading and the registered queries."""
