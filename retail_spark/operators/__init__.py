"""DataFrame -> DataFrame operators: silver transforms, quality checks,
dimensions, joins, gold metrics and graph features."""
