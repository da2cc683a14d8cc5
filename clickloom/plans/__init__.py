"""Whole jobs and the query registry with its SQL oracles."""
