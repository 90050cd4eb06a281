"""DataFrame operators: filters, joins, ranks, measures, checks."""
