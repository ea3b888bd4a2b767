"""Review analytics as DataFrame plans: ingestion, features, Gold grains, serving, checks."""
