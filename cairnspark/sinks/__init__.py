"""Writers: GeoParquet, search index, features, tile selection, caches."""
