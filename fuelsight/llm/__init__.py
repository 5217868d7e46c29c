"""Operators for building training corpora (self-contained: nothing else in the library imports this subpackage)."""
