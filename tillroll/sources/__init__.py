"""Readers, writers and session helpers."""
