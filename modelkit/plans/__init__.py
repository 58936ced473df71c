"""The operators applied to the driver tables, each with an independent SQL statement of the result."""
