"""Column expressions: no actions, no Python workers, legal in batch and streams."""
