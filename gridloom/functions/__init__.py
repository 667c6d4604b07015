"""Geometry kernels and column helpers."""
