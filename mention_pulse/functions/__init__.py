"""Column expressions: no action, no shuffle, no Python on the executors."""
