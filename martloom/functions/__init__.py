"""Column expressions: no UDFs, so every one of them stays inside generated code."""
