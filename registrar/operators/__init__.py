"""DataFrame operators: interval algebra, lookups, aggregates, row generators,
quality routing, identity, de-duplication."""
