"""Document term ranking and clustering as Spark DataFrame jobs."""
