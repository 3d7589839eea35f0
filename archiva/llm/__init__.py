"""Operators for training data and the queries on them; nothing outside imports this subpackage."""
