"""Operators on the parallel corpus and on nearest records in time.  Nothing else in the library imports this package."""
