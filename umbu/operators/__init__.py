"""Frame operators: columns, rows, joins, lookups, aggregates, reshaping."""
