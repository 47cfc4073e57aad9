"""Scalar column functions: RDF literals, titles, map features, geometry, display, months."""
