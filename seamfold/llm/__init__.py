"""Operators for building training corpora out of large text tables.

Self-contained: nothing else in the library imports this subpackage.
"""
