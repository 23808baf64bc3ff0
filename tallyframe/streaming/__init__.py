"""Frames over streams."""
