"""Column-expression helpers and the Arrow kernels used by the operators."""
