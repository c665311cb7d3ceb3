"""Whole studies assembled from the operators, and the registered queries."""
