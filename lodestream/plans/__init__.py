"""Compositions of operators, and the catalog of checked queries."""
