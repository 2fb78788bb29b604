"""Equity factor research on PySpark: bar panels, factors, ranking, portfolio analytics."""
