"""The same aggregates over streams of cells."""
