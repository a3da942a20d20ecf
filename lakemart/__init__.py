"""lakemart: a commerce warehouse pipeline written as Spark DataFrame jobs."""
