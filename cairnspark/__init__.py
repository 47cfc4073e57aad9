"""Geotagged-article analytics on Spark: sources, operators, sinks, queries."""
