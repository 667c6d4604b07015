"""Array stores, rasters, catalogues and vector files as DataFrames, and the array sink."""
