"""Column expressions: geometry, projection, raster arithmetic, text and dates."""
