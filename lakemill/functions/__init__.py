"""Column expressions: labels, text features, lexicon features, optional scorers."""
