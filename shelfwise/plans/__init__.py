"""Analytical queries over the relational model, and the registry of checked queries."""
