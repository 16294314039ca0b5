"""lakemart: admission-style reporting marts as plain Spark DataFrame jobs."""
