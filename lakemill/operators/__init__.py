"""Table operators: Silver join, filters, Gold grains, serving tables, checks, analytics."""
