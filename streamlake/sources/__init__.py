"""Readers for the lake zones, manifests and the table catalog."""
