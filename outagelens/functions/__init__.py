"""Column expressions: no actions, no UDFs, all inside generated code."""
