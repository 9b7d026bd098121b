"""Column-level building blocks: text cleaning, kernels, densities, hash order."""
