"""Readers, writers and the stored queue."""
