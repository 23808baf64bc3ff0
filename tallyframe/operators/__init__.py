"""Verbs of frames."""
