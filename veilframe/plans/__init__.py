"""Column roles and the composed jobs."""
