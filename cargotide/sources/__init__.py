"""Readers, writers and calendar tables."""
