"""Readers and writers of the archive's files."""
