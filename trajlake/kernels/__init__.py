"""NumPy kernels for what is sequential or iterative inside one group; the operators call them through applyInPandas."""
