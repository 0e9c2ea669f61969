"""DataFrame operators: reshaping, joins, windows, aggregates."""
