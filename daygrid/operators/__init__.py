"""Reusable DataFrame operators. Each one is lazy and returns a DataFrame."""
