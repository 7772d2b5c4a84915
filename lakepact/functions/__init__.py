"""Column functions: text normalisation, flags, type names, fixed value lists."""
