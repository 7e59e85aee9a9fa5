"""Published forms of the tables."""
