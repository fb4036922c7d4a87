"""Operators that prepare training data; each is a module of its own."""
