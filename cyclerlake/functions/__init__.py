"""Column-level building blocks: predicates, unit conversions, vocabulary."""
