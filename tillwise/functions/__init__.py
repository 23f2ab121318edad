"""Column-expression functions (no UDFs)."""
