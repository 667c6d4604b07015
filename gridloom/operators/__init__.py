"""Operators over cells and footprints."""
