"""Column functions: time buckets, text cleaning, event checks."""
