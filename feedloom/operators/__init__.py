"""DataFrame -> DataFrame operators: fan-out, store semantics, reads, graph."""
