"""flowwarden: flow scoring and alert analytics as Spark DataFrame jobs."""
