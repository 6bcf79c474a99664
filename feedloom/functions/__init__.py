"""Column-level functions: JSON parse/validate, time handling, rendering."""
