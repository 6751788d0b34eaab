"""Readers, writers and the adapter over the supplied tables."""
