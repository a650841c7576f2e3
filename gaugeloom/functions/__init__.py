"""Column expressions: text, values, time, lookups and JSON flattening."""
