"""Reusable DataFrame operators: conflict resolution, aggregations, joins, filters, windows, order statistics."""
