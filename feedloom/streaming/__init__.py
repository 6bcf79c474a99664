"""Structured Streaming runtime for the fan-out job (ST1-ST6)."""
