"""Structured Streaming forms of the operators (STR-1..7)."""
