"""Operators ``DataFrame -> DataFrame`` over listings."""
