"""Column expressions: text cleaning, hashing, literal lookups."""
