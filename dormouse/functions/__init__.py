"""Column functions: time conversion, staleness predicates and text."""
