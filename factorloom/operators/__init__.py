"""Filters, joins, metrics, ranking, portfolio analytics and the trade calendar."""
