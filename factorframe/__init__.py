"""Ratings, factor models and recommendations as Spark DataFrame operators."""

from . import functions, operators, plans, schema, sources, streaming

__all__ = ["functions", "operators", "plans", "schema", "sources", "streaming"]
