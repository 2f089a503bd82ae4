"""Readers: paged REST, landed JSON, CSV snapshots, catalog tables."""
