"""Operators of a training-data pipeline over documents and vectors. Nothing outside this package imports it."""
