"""DataFrame -> DataFrame operators of the coverage job (one module per step)."""
