"""DataFrame operators: columns, grouping, joins, set operations, reshaping, series."""
