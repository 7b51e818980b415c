"""Column builders (pure Catalyst expressions, no Python UDFs)."""
