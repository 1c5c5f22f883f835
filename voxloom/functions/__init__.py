"""Column builders and vectorised kernels."""
