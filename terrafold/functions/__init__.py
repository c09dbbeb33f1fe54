"""Column functions (JVM-side expressions) and NumPy geometry kernels."""
