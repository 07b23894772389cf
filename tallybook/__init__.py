"""Transaction reconciliation as Spark DataFrame jobs."""
