"""Relational operators over change events, dimensions and facts."""
