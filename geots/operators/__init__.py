"""DataFrame operators: grid, joins, sampling, monthly statistics, comparison, reshaping."""
