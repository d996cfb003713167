"""Key, constraint, join and ranking operators."""
