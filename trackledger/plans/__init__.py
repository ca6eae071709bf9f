"""User-level jobs, each a composition of operators over all sheets at once."""
