"""Composed plans: batch fan-out, timeline reads, audits, query registry."""
