"""Training-data operators: deduplication, scoring, tokenisation, formatting.

Nothing outside this subpackage imports it. ``queries`` holds the registered
queries and their SQL; each other module is one operator or shared support.
"""
