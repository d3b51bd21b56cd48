"""Search and facets over document tables, written as Spark DataFrame jobs."""
