"""Column functions: text standardisation and numeric coercion."""
