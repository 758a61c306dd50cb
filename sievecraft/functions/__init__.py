"""Column functions: text cleaning, identifiers and text-pair similarity."""
