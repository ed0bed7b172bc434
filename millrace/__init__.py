"""Analytics jobs on large tables, written with the Spark DataFrame API and MLlib."""
