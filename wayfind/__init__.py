"""Planning, cleaning and accounting of web-discovery data as Spark jobs."""
