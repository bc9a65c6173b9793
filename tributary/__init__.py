"""Company-risk analytics as Spark DataFrame jobs."""
