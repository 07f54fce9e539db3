"""DataFrame operators: snapshots, joins, aggregates, numbering, scoring, sinks."""
