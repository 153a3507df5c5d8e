"""Road-traffic and event analytics expressed as Spark DataFrame jobs."""
