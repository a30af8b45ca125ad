"""Column contracts, normalization rules, physical layouts and load plans."""
