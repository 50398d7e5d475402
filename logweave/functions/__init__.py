"""Column expressions: header lookup, byte layouts, routing, report lines."""
