"""Column functions: time and text formatting, vectors, geometry. No Python UDFs."""
