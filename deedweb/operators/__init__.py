"""Operators over tables."""
