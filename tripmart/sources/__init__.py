"""Readers of the layers and the raw sources, and the landing of raw files."""
