"""Table operators: merges, row history, keys, hierarchies, lookups, checks and layout."""
