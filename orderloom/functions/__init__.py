"""Column rules: every function here takes and returns Spark Columns."""
