"""Whole loads built from the operators, and the tables they publish."""
