"""Column functions: value maps, codes, dates."""
