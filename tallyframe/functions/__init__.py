"""Expressions and their functions."""
