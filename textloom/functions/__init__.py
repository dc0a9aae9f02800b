"""Column functions and the executor-side model hook."""
