"""Operators that combine several DataFrame steps."""
