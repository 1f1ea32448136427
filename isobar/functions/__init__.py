"""Column functions: times, record ids, nested paths."""
