"""Column functions: text cleaning, n-grams, labels, flags and dates."""
