"""kinomill: clean overlapping film sources, map them to a graph, query it. All on Spark."""
