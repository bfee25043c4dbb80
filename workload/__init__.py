"""Stand-in inputs, registered queries and their SQL twins."""
