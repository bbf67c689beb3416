"""Operators: vectorisation, n-grams, k-means, canopy, evaluation, top-k."""
