"""Reusable DataFrame operators (rows, aggregates, joins, sets, columns, graph, resolve, wikimatch, categories, enrich)."""
