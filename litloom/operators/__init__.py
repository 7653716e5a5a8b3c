"""Operators on publications, mentions and evidence."""
