"""DataFrame -> DataFrame operators of the article table."""
