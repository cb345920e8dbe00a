"""Operators of the library, one module per family."""
