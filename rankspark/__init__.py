"""rankspark: text retrieval and its evaluation as Spark DataFrame jobs."""
