"""Readers and writers for landed payloads, plus fixture views of driver tables."""
