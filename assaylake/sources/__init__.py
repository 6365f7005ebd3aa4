"""Readers, writers and the adapters onto the benchmark tables."""
