"""Plans: the named extracts, the run catalogue and the spec runner."""
