"""scorekit: risk-score building blocks expressed as Spark DataFrame jobs."""
