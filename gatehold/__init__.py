"""Flight-delay and weather analytics as Spark DataFrame jobs."""
