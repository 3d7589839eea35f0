"""Queries over the catalogue's tables, with their SQL where SQL can say the same."""
