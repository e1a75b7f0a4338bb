"""Column expressions: casts, timestamps, identities, message validation."""
