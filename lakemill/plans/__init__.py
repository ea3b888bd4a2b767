"""Input adapters and the catalog of registered queries."""
