"""Batch operators over tables."""
