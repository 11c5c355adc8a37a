"""hanji: document analytics and vector search as Spark jobs."""
