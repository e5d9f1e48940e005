"""Column expressions shared by the layers (built-in functions only, no UDFs)."""
