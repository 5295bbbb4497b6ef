"""Operators: ``DataFrame -> DataFrame`` functions, one family per module."""
