"""Column functions: keys, times, rounding, hashes and checks."""
