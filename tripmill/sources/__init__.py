"""Readers, writers and the layout of the stored tables."""
