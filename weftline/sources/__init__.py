"""Readers: driver tables in the demand domain's terms, and split files with provenance."""
