"""Column expressions: scalars, predicates, log parsing, fingerprints."""
