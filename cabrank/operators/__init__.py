"""Building blocks shared by the analyses: cleaning, joins, aggregates, windows, statistics."""
