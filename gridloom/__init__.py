"""A PySpark engine for chunked N-dimensional geospatial arrays."""
