"""Readers, writers and catalogue access: the edge of the library."""
