"""Operators of a large text-corpus pipeline. Nothing else in the library imports this package."""
