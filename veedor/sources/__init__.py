"""Readers: contracts, JSON record batches, URL lists, captured pages."""
