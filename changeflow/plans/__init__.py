"""Declared jobs and the queries that run every operator on the given tables."""
