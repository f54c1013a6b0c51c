"""Column builders: predicates, rule arrays, record identity, measures, calendar."""
