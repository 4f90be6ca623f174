"""DataFrame operators: deduplication, quality rules, privacy, dimensional modelling, history."""
