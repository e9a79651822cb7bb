"""Scans: artifact files, manifests, landed API payloads, run directories."""
