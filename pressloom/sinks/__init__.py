"""Artifact rows, manifests, reports and table publishing."""
