"""Training-data operators and their queries. Nothing else in the library imports this."""
