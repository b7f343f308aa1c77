"""Column expressions: text of queries, URLs, dates and schedules."""
