"""DataFrame -> DataFrame operators (aggregation, indexing, joins, matrices, ML, evaluation)."""
