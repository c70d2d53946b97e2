"""Jobs composed of the operators, and the queries over the driver tables."""
