"""Readers, writers and generators of the four retail tables."""
