"""Queries over the given tables, with their SQL counterparts."""
