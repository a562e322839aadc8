"""Readers, writers and the bridge from plain tables to the knowledge store."""
