"""Zone-hour demand analytics as plain Spark DataFrame operators."""
