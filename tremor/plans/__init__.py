"""Composed jobs and the named-query registry."""
