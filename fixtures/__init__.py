"""Energy tables derived from the driver's star schema, for queries, tests and bench."""
