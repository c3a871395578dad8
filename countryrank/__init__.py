"""Country attribution and ranking of repositories as Spark DataFrame jobs."""
