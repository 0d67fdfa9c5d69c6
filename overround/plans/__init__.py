"""Plans: market operators, end-to-end runs and the registered query catalogue."""
