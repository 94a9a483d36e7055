"""Column-level building blocks: merge operators, keys, decoders."""
