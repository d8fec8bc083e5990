"""End-to-end plans and the queries bound to the given tables."""
