"""Daily gridded observations as Spark jobs: clean, complete, score, publish and query."""
