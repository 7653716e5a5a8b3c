"""Readers, writers and schema helpers."""
