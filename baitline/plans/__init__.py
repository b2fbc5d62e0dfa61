"""Whole jobs composed from operators, and the shared scale-out helpers."""
