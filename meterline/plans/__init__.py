"""Jobs: the staged pipeline, table maintenance, and the query registry."""
