"""DataFrame operators: ordered series, cleaning, catalog joins, selection, assessment."""
